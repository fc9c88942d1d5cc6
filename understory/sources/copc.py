"""Octree-ordered LAS (COPC 1.0): detection, header and hierarchy. The node table says which byte ranges hold a window's
points and how many there are; decompressing them isn't built.

All reading goes through Hadoop's file systems, a page at a time; subtrees outside the window are not read."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession

from ..model import ConfigError

#: The info record stands right behind the header of a LAS 1.4 file.
HEADER, VLR, ENTRY = 375, 54, 32
NODES = "level int, x int, y int, z int, offset long, bytes int, points int, xmin double, ymin double, zmin double, size double"


def read_range(spark: SparkSession, path: str, start: int, size: int) -> bytes:
    """Up to size bytes of a file from start on."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    size = max(0, min(size, fs.getFileStatus(p).getLen() - start))
    f = fs.open(p)
    try:
        f.seek(start)
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(f, size)) if size else b""
    finally:
        f.close()


def is_copc(head: bytes) -> bool:
    """From a file's first bytes (393 at least)."""
    return len(head) >= HEADER + 18 and head[:4] == b"LASF" and head[HEADER + 2 : HEADER + 6] == b"copc"


def copc_info(spark: SparkSession, path: str) -> dict:
    """Point count, extent, cube and place of the root page."""
    raw = read_range(spark, path, 0, HEADER + VLR + 160)
    if not is_copc(raw) or len(raw) < HEADER + VLR + 160:
        raise ConfigError(f"{path} is no octree-ordered LAS file")
    n = struct.unpack_from("<Q", raw, 247)[0]
    xmax, xmin, ymax, ymin, zmax, zmin = struct.unpack_from("<6d", raw, 179)
    cx, cy, cz, half, spacing = struct.unpack_from("<5d", raw, HEADER + VLR)
    at, size = struct.unpack_from("<2Q", raw, HEADER + VLR + 40)
    if half <= 0 or not size or size % ENTRY:
        raise ConfigError(f"{path} has a broken info record")
    return {"points": n, "box": (xmin, ymin, zmin, xmax, ymax, zmax), "low": (cx - half, cy - half, cz - half), "size": 2 * half, "spacing": spacing, "root": (at, size)}


def copc_nodes(spark: SparkSession, path: str, window: tuple[float, float, float, float] | None = None) -> DataFrame:
    """One row for each node with points whose cube meets the window (xmin, ymin, xmax, ymax), half-open. Without a window
    the nodes must hold exactly the header's points. A page that comes twice and a broken entry are errors."""
    info = copc_info(spark, path)
    rows, pages, seen = [], [info["root"]], set()
    while pages:
        at, size = pages.pop()
        if at in seen or size <= 0 or size % ENTRY:
            raise ConfigError(f"{path} has a broken hierarchy")
        seen.add(at)
        raw = read_range(spark, path, at, size)
        if len(raw) < size:
            raise ConfigError(f"{path} ends within its hierarchy")
        for level, x, y, z, offset, n_bytes, points in struct.iter_unpack("<4iQ2i", raw):
            edge = info["size"] / (1 << level) if 0 <= level < 62 else 0
            if not edge or min(x, y, z) < 0 or points < -1:
                raise ConfigError(f"{path} has a broken hierarchy")
            low = [a + k * edge for a, k in zip(info["low"], (x, y, z))]
            if window and not (low[0] < window[2] and low[0] + edge >= window[0] and low[1] < window[3] and low[1] + edge >= window[1]):
                continue
            if points == -1:
                pages.append((offset, n_bytes))
            elif points:
                rows.append((level, x, y, z, offset, n_bytes, points, *low, edge))
    if window is None and sum(r[6] for r in rows) != info["points"]:
        raise ConfigError(f"{path}: the hierarchy doesn't hold the header's {info['points']} points")
    return spark.createDataFrame(rows, NODES)
