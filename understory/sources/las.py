"""Spark data source for uncompressed LAS 1.2-1.4 files: spark.read.format("las").load(path).

A file is read in blocks of points, one partition each; extra byte attributes become double columns."""

from __future__ import annotations

import glob
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

BLOCK = 1_000_000
#: Layout of the point formats, sizes, and types of extra bytes.
BASE = {"X": "<i4", "Y": "<i4", "Z": "<i4", "Intensity": "<u2"}
SIZES = {0: 20, 1: 28, 2: 26, 3: 34, 6: 30, 7: 36, 8: 38}
EXTRA = {1: "<u1", 2: "<i1", 3: "<u2", 4: "<i2", 5: "<u4", 6: "<i4", 7: "<u8", 8: "<i8", 9: "<f4", 10: "<f8"}


def resolve(path: str) -> list[str]:
    """One file, or the .las files of a folder, sorted."""
    return sorted(p for p in glob.glob(f"{path}/*") if p.lower().endswith(".las")) if os.path.isdir(path) else [path]


def read_header(path: str) -> dict:
    with open(path, "rb") as f:
        h = f.read(375)
        if h[:4] != b"LASF":
            raise ValueError(f"{path} is no LAS file")
        fmt, size, n = struct.unpack_from("<BHI", h, 104)
        head, at, vlrs = struct.unpack_from("<HII", h, 94)
        if fmt & 0x80:
            raise ValueError(f"{path} is compressed; only uncompressed LAS is read")
        if fmt not in SIZES:
            raise ValueError(f"point format {fmt} isn't supported")
        if h[25] >= 4:
            n = struct.unpack_from("<Q", h, 247)[0]
        scale, offset = struct.unpack_from("<3d", h, 131), struct.unpack_from("<3d", h, 155)
        box = struct.unpack_from("<6d", h, 179)
        f.seek(head)
        extra, wkt = [], None
        for _ in range(vlrs):
            v = f.read(54)
            user, rid, length = v[2:18].rstrip(b"\0"), *struct.unpack_from("<HH", v, 18)
            body = f.read(length)
            if user == b"LASF_Spec" and rid == 4:
                for i in range(0, len(body), 192):
                    d = body[i : i + 192]
                    kind, opts = d[2], d[3]
                    s, o = struct.unpack_from("<d", d, 112)[0] if opts & 8 else 1.0, struct.unpack_from("<d", d, 136)[0] if opts & 16 else 0.0
                    extra.append((d[4:36].rstrip(b"\0").decode(), EXTRA[kind], s, o))
            elif user == b"LASF_Projection" and rid == 2112:
                wkt = body.rstrip(b"\0").decode()
    return {"format": fmt, "size": size, "n": n, "at": at, "scale": scale, "offset": offset, "box": box, "extra": extra, "wkt": wkt}


def decode(raw: bytes, h: dict) -> dict[str, np.ndarray]:
    size, fmt = h["size"], h["format"]
    rows = np.frombuffer(raw, np.uint8).reshape(-1, size)
    field = lambda at, kind: np.ascontiguousarray(rows[:, at : at + np.dtype(kind).itemsize]).view(kind)[:, 0]
    out = {c: field(4 * i, "<i4") * h["scale"][i] + h["offset"][i] for i, c in enumerate("XYZ")}
    out["Intensity"] = field(12, "<u2").astype("i4")
    flags = field(14, "<u1").astype("i4")
    if fmt >= 6:
        out |= {"ReturnNumber": flags & 15, "NumberOfReturns": flags >> 4, "Classification": field(16, "<u1").astype("i4"), "PointSourceID": field(20, "<u2").astype("i4"), "gpstime": field(22, "<f8").astype("f8")}
    else:
        out |= {"ReturnNumber": flags & 7, "NumberOfReturns": (flags >> 3) & 7, "Classification": field(15, "<u1").astype("i4") & 31, "PointSourceID": field(18, "<u2").astype("i4")}
        if fmt in (1, 3):
            out["gpstime"] = field(20, "<f8").astype("f8")
    at = SIZES[fmt]
    for name, kind, s, o in h["extra"]:
        out[name] = field(at, kind) * s + o
        at += np.dtype(kind).itemsize
    return out


class Block(InputPartition):
    def __init__(self, path, first, n):
        self.path, self.first, self.n = path, first, n


class LasReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names, self.paths = [f.name for f in schema.fields], resolve(options["path"])

    def partitions(self):
        out = []
        for p in self.paths:
            n = read_header(p)["n"]
            out += [Block(p, i, min(BLOCK, n - i)) for i in range(0, n, BLOCK)]
        return out or [Block(None, 0, 0)]

    def read(self, part):
        if part.path is None:
            return
        h = read_header(part.path)
        with open(part.path, "rb") as f:
            f.seek(h["at"] + part.first * h["size"])
            raw = f.read(part.n * h["size"])
        if len(raw) != part.n * h["size"]:
            raise ValueError(f"{part.path} ends early")
        cols = decode(raw, h)
        kinds = {"f8": pa.float64(), "i4": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(cols[n].astype("f8" if cols[n].dtype.kind == "f" else "i4"), kinds["f8" if cols[n].dtype.kind == "f" else "i4"]) if n in cols else pa.nulls(part.n, pa.float64()) for n in self.names], self.names)


class LasSource(DataSource):
    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        fields: dict = {}
        for p in resolve(self.options["path"]):
            h = read_header(p)
            sample = decode(bytes(h["size"]), h)
            fields |= {n: DoubleType() if a.dtype.kind == "f" else IntegerType() for n, a in sample.items()}
        return StructType([StructField(n, t) for n, t in fields.items()])

    def reader(self, schema):
        return LasReader(schema, self.options)


def header_table(spark, path: str):
    """One row for each file: count, box, WKT."""
    rows = [(p, h["n"], *map(float, h["box"]), h["wkt"]) for p in resolve(path) for h in [read_header(p)]]
    if len({r[-1] for r in rows if r[-1]}) > 1:
        raise ValueError("files differ in their coordinate system")
    return spark.createDataFrame(rows, "path string, n bigint, max_x double, min_x double, max_y double, min_y double, max_z double, min_z double, wkt string")
