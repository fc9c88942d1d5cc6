"""Terrain as a table of cells: model from ground points, lookup by equi-join, height normalisation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cell, finite
from ..model import ConfigError
from .nearest import nearest_points
from .voxel import surface_candidates

#: Terrain cells up to which the table is sent to all tasks; beyond, it is joined by cell.
BROADCAST_CELLS = 2_000_000


def normalise_height(df: DataFrame, dtm: DataFrame, res: float, strict: bool = True, cells: int | None = None) -> DataFrame:
    """Z becomes the height over dtm (row, col, z); Zref keeps the old Z. A point without terrain is an error if strict."""
    keyed = df.withColumns({"_row": cell(F.col("Y"), res), "_col": cell(F.col("X"), res)})
    n = dtm.count() if cells is None else cells
    small = F.broadcast(dtm) if n <= BROADCAST_CELLS else dtm
    t = small.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("z").cast("double").alias("_t"))
    out = keyed.join(t, (F.col("_row") == F.col("_r")) & (F.col("_col") == F.col("_c")), "left")
    ground = F.when(finite(F.col("_t")).isNotNull(), F.col("_t")).otherwise(F.raise_error(F.lit("a point lies outside the terrain")).cast("double")) if strict else F.col("_t")
    return out.withColumn("Zref", F.col("Z")).withColumn("Z", F.col("Zref") - ground).drop("_row", "_col", "_r", "_c", "_t")


def ground_is_valid(df: DataFrame) -> bool:
    """At least three class-2 points over two or more distinct X and Y."""
    if "Classification" not in df.columns:
        return False
    g = df.where("Classification = 2 and X is not null and Y is not null and Z is not null").agg(F.count("*").alias("n"), (F.max("X") > F.min("X")).alias("x"), (F.max("Y") > F.min("Y")).alias("y")).first()
    return bool(g.n >= 3 and g.x and g.y)


def cloth(points: np.ndarray, size: float, rounds: int = 150, near: float = 0.5) -> np.ndarray:
    """True for ground: a cloth on a grid falls on the upside-down points, and neighbours pull it even (cloth simulation)."""
    ij = np.floor(points[:, :2] / size).astype(np.int64)
    lo = ij.min(0)
    ij -= lo
    shape = tuple(ij.max(0) + 1)
    floor = np.full(shape, np.inf)
    np.minimum.at(floor, (ij[:, 0], ij[:, 1]), points[:, 2])
    known = np.isfinite(floor)
    for _ in range(max(shape)):  # holes take the lowest neighbour
        if known.all():
            break
        pad = np.pad(np.where(known, floor, np.inf), 1, constant_values=np.inf)
        around = np.minimum.reduce([pad[:-2, 1:-1], pad[2:, 1:-1], pad[1:-1, :-2], pad[1:-1, 2:]])
        new = ~known & np.isfinite(around)
        floor[new], known = around[new], known | new
    h = np.full(shape, floor.min() - near)
    speed = np.zeros(shape)
    for _ in range(rounds):
        stuck = h >= floor
        speed = np.where(stuck, 0, speed + near / 10)
        h = np.minimum(floor, h + speed)
        for _ in range(3):
            pad = np.pad(h, 1, mode="edge")
            mean = (pad[:-2, 1:-1] + pad[2:, 1:-1] + pad[1:-1, :-2] + pad[1:-1, 2:]) / 4
            h = np.where(h >= floor, np.minimum(h, floor), np.minimum(floor, h + 0.5 * (mean - h)))
    return np.abs(points[:, 2] - h[ij[:, 0], ij[:, 1]]) <= near


def interpolate(points: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = 8, batch: int = 20_000) -> np.ndarray:
    """Plane through the k nearest points of each place, inverse-distance weighted; a plane surface comes back exactly."""
    places, out = np.column_stack([x, y]), np.empty(len(x))
    near = nearest_points(points[:, :2], places, k)
    for at in range(0, len(x), batch):
        p = points[near[at : at + batch]]
        dx, dy = (p[..., j] - places[at : at + batch, j, None] for j in (0, 1))
        w = 1 / (np.hypot(dx, dy) + 1e-6)
        a = np.stack([w, w * dx, w * dy], 2)
        out[at : at + batch] = np.einsum("nj,nj->n", np.linalg.pinv(a)[:, 0], w * p[..., 2])
    return out


def make_dtm(df: DataFrame, resolution: float = 0.2, tile: float = 50.0, buffer: float = 5.0, candidate: float = 0.1) -> DataFrame:
    """(row, col, z) terrain. Class-2 points if valid, else a cloth ground filter on the lowest point of each candidate
    cell. Tiles with a buffer are groups of bounded density; each gives the cells of its core, over the box of all its points,
    ground or not. A tile with under three ground points, buffer included, has no terrain."""
    per = max(1, round(tile / resolution))
    tile = per * resolution  # whole cells
    ground = df.where("Classification = 2") if ground_is_valid(df) else None
    low = surface_candidates(ground if ground is not None else df, candidate)
    spread = lambda c: F.explode(F.sequence(F.floor((F.col(c) - buffer) / tile).cast("long"), F.floor((F.col(c) + buffer) / tile).cast("long")))
    cells = df.select(cell(F.col("X"), resolution).alias("c"), cell(F.col("Y"), resolution).alias("r")).where("c is not null and r is not null")
    boxes = cells.groupBy(F.floor(F.col("c") / per).alias("tx"), F.floor(F.col("r") / per).alias("ty")).agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("r").alias("r0"), F.max("r").alias("r1"))
    halo = low.withColumn("tx", spread("X")).withColumn("ty", spread("Y")).join(boxes, ["tx", "ty"])
    classify = ground is None

    def surface(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        p = f[["X", "Y", "Z"]].sort_values(["X", "Y"]).to_numpy(float)
        empty = pd.DataFrame({"row": pd.Series(dtype="int64"), "col": pd.Series(dtype="int64"), "z": pd.Series(dtype="float32")})
        if len(p) < 3 or np.ptp(p[:, 0]) == 0 or np.ptp(p[:, 1]) == 0:
            return empty
        if classify:
            p = p[cloth(p, max(0.5, candidate))]
        if len(p) < 3:
            return empty
        c0, c1, r0, r1 = (int(f[c].iloc[0]) for c in ("c0", "c1", "r0", "r1"))
        cc, rr = (g.ravel() for g in np.meshgrid(np.arange(c0, c1 + 1), np.arange(r0, r1 + 1)))
        z = interpolate(p, (cc + 0.5) * resolution, (rr + 0.5) * resolution)
        return pd.DataFrame({"row": rr, "col": cc, "z": z.astype("float32")})

    return halo.groupBy("tx", "ty").applyInPandas(surface, "row bigint, col bigint, z float")


def read_dtm(spark, path: str, points: DataFrame, res: float) -> DataFrame:
    """A supplied terrain table (row, col, z); it must cover the points' extent."""
    dtm = spark.read.parquet(path).select("row", "col", "z")
    b = dtm.agg(F.min("row"), F.max("row"), F.min("col"), F.max("col")).first()
    e = points.agg(F.min("X"), F.min("Y"), F.max("X"), F.max("Y")).first()
    if e[0] is not None and (b[0] is None or b[2] > np.floor(e[0] / res) or b[0] > np.floor(e[1] / res) or b[3] < np.floor(e[2] / res) or b[1] < np.floor(e[3] / res)):
        raise ConfigError("the supplied terrain doesn't cover the cloud")
    return dtm
