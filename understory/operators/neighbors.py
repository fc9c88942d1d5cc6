"""Neighbourhood joins as equi-joins on cells: no pair is looked at outside the 3^d cells around a point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import cell, finite
from ..plans.storage import written


def _halo(df: DataFrame, dims: tuple[str, ...], size: float, reach: int = 1) -> DataFrame:
    """Each row once for every cell around its own."""
    for i, d in enumerate(dims):
        df = df.withColumn(f"_c{i}", F.explode(F.sequence(cell(F.col(d), size) - reach, cell(F.col(d), size) + reach)))
    return df


def _cells(df: DataFrame, dims: tuple[str, ...], size: float) -> DataFrame:
    return df.withColumns({f"_c{i}": cell(F.col(d), size) for i, d in enumerate(dims)})


def radius_join(left: DataFrame, right: DataFrame, radius: float, dims: tuple[str, ...] = ("X", "Y", "Z"), id_col: str = "id", itself: bool = False) -> DataFrame:
    """(src, dst, d): ordered pairs within the radius, its border included."""
    a = _cells(left.select(F.col(id_col).alias("src"), *dims), dims, radius)
    b = _halo(right.select(F.col(id_col).alias("dst"), *dims), dims, radius).withColumnsRenamed({d: f"_{d}" for d in dims})
    sq = sum(((F.col(d) - F.col(f"_{d}")) * (F.col(d) - F.col(f"_{d}")) for d in dims), F.lit(0.0))
    out = a.join(b, [f"_c{i}" for i in range(len(dims))]).withColumn("d2", sq).where(F.col("d2") <= radius * radius + 1e-12)
    return (out if itself else out.where("src <> dst")).select("src", "dst", F.sqrt("d2").alias("d"))


def density(df: DataFrame, radius: float, dims: tuple[str, ...] = ("X", "Y"), id_col: str = "id") -> DataFrame:
    """Neighbours of each point within the radius, itself included."""
    return radius_join(df, df, radius, dims, id_col, itself=True).groupBy(F.col("src").alias(id_col)).agg(F.count("*").alias("density"))


def knn(df: DataFrame, k: int, dims: tuple[str, ...] = ("X", "Y", "Z"), id_col: str = "id", size: float = 1.0) -> DataFrame:
    """(src, rank, dst, d): the k nearest points, itself included. Ties go to the smaller id.

    A point is done when its k-th distance fits the searched radius; the rest are searched again with twice the cell.
    That ends when the cell spans the cloud, as k is at most the number of points. Points without an id or finite
    coordinates have no row."""
    for c in dims:
        df = df.where(finite(F.col(c)).isNotNull())
    df = df.where(F.col(id_col).isNotNull())
    rest, done = df, None
    total = df.count()
    k = min(k, total)
    order = Window.partitionBy("src").orderBy("d", "dst")
    while True:
        near = radius_join(rest, df, size, dims, id_col, itself=True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        near = written(near)
        full = near.groupBy("src").count().where(F.col("count") >= k).select(F.col("src").alias("_s"))
        part = near.join(full, F.col("src") == F.col("_s"), "left_semi")
        done = part if done is None else done.unionByName(part)
        rest = written(rest.join(full, F.col(id_col) == F.col("_s"), "left_anti"))
        if not rest.limit(1).count():
            break
        size *= 2
    return done.select("src", F.col("rank").cast("int"), "dst", "d")


def knn_arrays(queries: DataFrame, points: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """k nearest arrays of a small set of queries: those are sent to every task, which keeps k for each."""
    q = queries.select(F.col(id_col).alias("src"), F.col(vec_col).cast("array<double>").alias("a"))
    p = points.select(F.col(id_col).alias("dst"), F.col(vec_col).cast("array<double>").alias("b"))
    d = F.sqrt(F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = p.join(F.broadcast(q), F.col("src") != F.col("dst")).select("src", "dst", d.alias("d"))
    order = Window.partitionBy("src").orderBy("d", "dst")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("src", F.col("rank").cast("int"), "dst", "d")
