"""Grid operators: voxels, thinning, rasters and minimum surfaces. Keys are integers; each is one shuffle with partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cell, cell_centre


def add_voxel_coordinates(df: DataFrame, res: float) -> DataFrame:
    """Voxel keys and centres; the grid's z origin lies half a cell lower."""
    if res <= 0:
        raise ValueError("the voxel size must be above 0")
    z0 = -0.5 * res
    out = df.withColumns({"vx": cell(F.col("X"), res), "vy": cell(F.col("Y"), res), "vz": cell(F.col("Z"), res, z0)})
    return out.withColumns({"x_vox": cell_centre(F.col("vx"), res), "y_vox": cell_centre(F.col("vy"), res), "z_vox": cell_centre(F.col("vz"), res, z0)})


def voxelize_points_mean_attributes(df: DataFrame, res: float) -> DataFrame:
    """Cell centre, centre of gravity (X_gr...) and the mean of every further numeric attribute."""
    rest = [c for c, t in df.dtypes if c not in ("X", "Y", "Z") and t not in ("string", "boolean", "binary") and not t.startswith(("array", "struct", "map"))]
    v = add_voxel_coordinates(df, res).groupBy("vx", "vy", "vz").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"{c}_gr") for c in "XYZ"], *[F.avg(c).alias(c) for c in rest])
    return v.select("vx", "vy", "vz", cell_centre(F.col("vx"), res).alias("X"), cell_centre(F.col("vy"), res).alias("Y"), cell_centre(F.col("vz"), res, -0.5 * res).alias("Z"), "X_gr", "Y_gr", "Z_gr", "n", *rest)


def grid_thin(df: DataFrame, grid: float, keys: tuple[str, ...], z: str = "Z") -> DataFrame:
    """One point for each tree and cell: the smallest by (X, Y, z). z is the height the cells are cut from."""
    k = {"kx": cell(F.col("X"), grid), "ky": cell(F.col("Y"), grid), "kz": cell(F.col(z), grid)}
    rest = [c for c in df.columns if c not in (*keys, "X", "Y", z)]
    out = df.withColumns(k).groupBy(*keys, *k).agg(F.min(F.struct("X", "Y", z, *rest)).alias("_p"))
    return out.select(*keys, *k, "_p.*")


def raster(df: DataFrame, res: float, **aggs) -> DataFrame:
    """Aggregates for each (px, py) pixel."""
    return df.groupBy(cell(F.col("X"), res).alias("px"), cell(F.col("Y"), res).alias("py")).agg(*[v.alias(k) for k, v in aggs.items()])


def min_surface(df: DataFrame, res: float) -> DataFrame:
    """Lowest point of each cell as 32-bit float."""
    return raster(df, res, z=F.min(F.col("Z").cast("float")))


def surface_candidates(df: DataFrame, res: float) -> DataFrame:
    """The minimum surface as points at the cells' centres: a terrain model's input of bounded density."""
    return min_surface(df, res).select(cell_centre(F.col("px"), res).alias("X"), cell_centre(F.col("py"), res).alias("Y"), F.col("z").cast("double").alias("Z"))


def height_slice(df: DataFrame, low: float, high: float, z: str = "Z") -> DataFrame:
    """Open interval."""
    return df.where((F.col(z) > low) & (F.col(z) < high))


def slice_join(df: DataFrame, low: float, high: float, step: float, width: float, keys: tuple[str, ...], z: str = "Z") -> DataFrame:
    """Points with the slice [low + i * step, ... + width) that holds them. A regular grid needs no range join: the slice
    number is arithmetic, the width a filter."""
    i = F.floor((F.col(z) - low) / step + 1e-9).cast("int")
    out = df.withColumn("slice_id", i + 1).withColumn("z_lo", F.lit(low) + (F.col("slice_id") - 1) * step)
    last = int((high - width - low) / step + 1e-9) + 1
    return out.where((F.col("slice_id") >= 1) & (F.col("slice_id") <= last) & (F.col(z) < F.col("z_lo") + width))


def slice_counts(df: DataFrame, low: float, high: float, step: float, width: float, z: str = "Z") -> DataFrame:
    """Points in each slice; empty slices stay."""
    last = int((high - width - low) / step + 1e-9) + 1
    slices = df.sparkSession.range(1, last + 1).select(F.col("id").cast("int").alias("slice_id"))
    got = slice_join(df, low, high, step, width, (), z).groupBy("slice_id").agg(F.count("*").alias("n"))
    return slices.join(got, "slice_id", "left").select("slice_id", F.coalesce("n", F.lit(0)).alias("n"))


def quantile_filter(df: DataFrame, key: str, columns: tuple[str, ...], q: float) -> DataFrame:
    """Rows above the q-quantile of their group in every column; NaN and NULL are left out of the quantiles."""
    clean = lambda c: F.when(~F.isnan(c), F.col(c))
    limits = df.groupBy(F.col(key).alias("_k")).agg(*[F.percentile(clean(c), F.lit(q)).alias(f"_q_{c}") for c in columns])
    out = df.join(limits, F.col(key) == F.col("_k"))
    for c in columns:
        out = out.where(clean(c) > F.col(f"_q_{c}"))
    return out.drop("_k", *[f"_q_{c}" for c in columns])
