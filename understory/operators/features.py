"""Eigenvalue features from covariance aggregates, in closed form: no Python in the plan."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neighbors import knn

FEATURES = ("Curvature", "Linearity", "Planarity", "Sphericity", "Anisotropy", "Verticality")


def covariance(dims: tuple[str, ...] = ("X", "Y", "Z")) -> list:
    """Sample covariances of a group."""
    a, b, c = dims
    return [F.covar_samp(p, q).alias(n) for n, p, q in (("cxx", a, a), ("cyy", b, b), ("czz", c, c), ("cxy", a, b), ("cxz", a, c), ("cyz", b, c))]


def eigen_decomposition(df: DataFrame) -> DataFrame:
    """l1 >= l2 >= l3 of the symmetric matrix (cxx ... cyz), and nz, the z part of the third axis.

    Trigonometric solution. nz^2 comes from the cofactors of C - l3 I: the diagonal of the adjugate is proportional to
    the squared parts of the axis."""
    c = F.col
    q = (c("cxx") + c("cyy") + c("czz")) / 3
    p1 = c("cxy") * c("cxy") + c("cxz") * c("cxz") + c("cyz") * c("cyz")
    df = df.withColumn("_q", q).withColumn("_p", F.sqrt(F.greatest(F.lit(0.0), ((c("cxx") - c("_q")) ** 2 + (c("cyy") - c("_q")) ** 2 + (c("czz") - c("_q")) ** 2 + 2 * p1) / 6)))
    a, b, d = ((c(n) - c("_q")) / c("_p") for n in ("cxx", "cyy", "czz"))
    e, f, g = (c(n) / c("_p") for n in ("cxy", "cxz", "cyz"))
    det = (a * (b * d - g * g) - e * (e * d - g * f) + f * (e * g - b * f)) / 2
    df = df.withColumn("_phi", F.when(c("_p") > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det))) / 3).otherwise(0.0))
    df = df.withColumn("l1", c("_q") + 2 * c("_p") * F.cos(c("_phi"))).withColumn("l3", c("_q") + 2 * c("_p") * F.cos(c("_phi") + 2 * math.pi / 3)).withColumn("l2", 3 * c("_q") - c("l1") - c("l3"))
    x, y, z = (c(n) - c("l3") for n in ("cxx", "cyy", "czz"))
    axx, ayy, azz = y * z - c("cyz") ** 2, x * z - c("cxz") ** 2, x * y - c("cxy") ** 2
    total = axx + ayy + azz
    nz = F.when(F.abs(total) > 0, F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), azz / total))))
    return df.withColumn("nz", nz).drop("_q", "_p", "_phi")


def eigen_features(df: DataFrame) -> DataFrame:
    """NULL where the largest eigenvalue is 0 (repeated points)."""
    l1, l2, l3 = (F.col(n) for n in ("l1", "l2", "l3"))
    ok = lambda x: F.when(l1 > 0, x)
    return df.withColumns({"Curvature": ok(l3 / (l1 + l2 + l3)), "Linearity": ok((l1 - l2) / l1), "Planarity": ok((l2 - l3) / l1), "Sphericity": ok(l3 / l1), "Anisotropy": ok((l1 - l3) / l1), "Verticality": ok(1 - F.abs(F.col("nz")))})


def add_geometry(df: DataFrame, k: int = 10, id_col: str = "id", size: float = 1.0) -> DataFrame:
    """df with the six features of each point's k nearest points."""
    if k < 3:
        raise ValueError("k must be at least 3")
    xyz = df.select(F.col(id_col).alias("dst"), "X", "Y", "Z")
    pairs = knn(df, k, id_col=id_col, size=size).select("src", "dst").join(xyz, "dst")
    f = eigen_features(eigen_decomposition(pairs.groupBy("src").agg(*covariance())))
    return df.drop(*FEATURES).join(f.select(F.col("src").alias(id_col), *FEATURES), id_col, "left")
