"""Convex hulls: merged from partial hulls, so that no task holds a tree's or a stand's points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def convex_hull(xy: np.ndarray) -> np.ndarray:
    """Vertices clockwise from the smallest; two ends if all points are on a line. Monotone chain."""
    p = xy[np.isfinite(xy).all(1)]
    if len(p) > 16:
        p = p[~_well_inside(p)]
    p = p[np.lexsort((p[:, 1], p[:, 0]))]
    p = p[np.concatenate([[True], (p[1:] != p[:-1]).any(1)])] if len(p) else p
    if len(p) < 3:
        return p

    def half(points):
        out: list = []
        for x, y in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (y - out[-2][1]) - (out[-1][1] - out[-2][1]) * (x - out[-2][0]) <= 0:
                out.pop()
            out.append((x, y))
        return out

    lower, upper = half(p.tolist()), half(p[::-1].tolist())
    ring = lower[:-1] + upper[:-1]
    return np.array([ring[0], *ring[:0:-1]])


_DIRECTIONS = np.array([[np.cos(a), np.sin(a)] for a in np.arange(12) * np.pi / 6])


def _well_inside(p: np.ndarray) -> np.ndarray:
    """Points strictly inside the polygon of the extreme points of twelve directions: no vertices of the hull."""
    e = p[(p @ _DIRECTIONS.T).argmax(0)]
    inside, edges = np.ones(len(p), bool), 0
    for a, b in zip(e, np.roll(e, -1, axis=0)):
        if (a != b).any():
            inside &= (b[0] - a[0]) * (p[:, 1] - a[1]) - (b[1] - a[1]) * (p[:, 0] - a[0]) > 1e-9
            edges += 1
    return inside if edges > 2 else np.zeros(len(p), bool)


def hull_vertices(df: DataFrame, keys: tuple[str, ...], least: int = 64) -> DataFrame:
    """(keys, ring): the hull of each group. Groups with many rows in an input batch are cut to their hull there, so that
    a group with a great share of all rows never meets whole in one task; hulls of hulls follow."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "X double", "Y double"])

    def partial(frames):
        for f in frames:
            if not keys:
                h = convex_hull(f[["X", "Y"]].to_numpy(float))
                yield pd.DataFrame({"X": h[:, 0], "Y": h[:, 1]})
                continue
            size = f.groupby(list(keys), dropna=False, sort=False)["X"].transform("size")
            yield f[size < least]
            for _, g in f[size >= least].groupby(list(keys), dropna=False, sort=False):
                h = convex_hull(g[["X", "Y"]].to_numpy(float))
                yield g.iloc[: len(h)].assign(X=h[:, 0], Y=h[:, 1])

    def final(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        h = convex_hull(f[["X", "Y"]].to_numpy(float))
        return pd.DataFrame([[*key, [{"x": float(x), "y": float(y)} for x, y in h]]], columns=[*keys, "ring"])

    part = df.select(*keys, F.col("X").cast("double"), F.col("Y").cast("double")).mapInPandas(partial, schema)
    out = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "ring array<struct<x:double,y:double>>"])
    if not keys:
        return part.groupBy(F.lit(0).alias("_all")).applyInPandas(lambda f: final((), f), "ring array<struct<x:double,y:double>>")
    return part.groupBy(*keys).applyInPandas(final, out)
