"""Farthest-point sampling and instance colours: iterative choices over distributed columns."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import written
from .neighbors import knn

#: Instances up to which their colours go to all tasks.
SEND = 1_000_000


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean 0, standard deviation 1."""
    s = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return df.withColumns({c: (F.col(c) - s[f"m{i}"]) / (s[f"s{i}"] or 1.0) for i, c in enumerate(columns)})


def fds(df: DataFrame, n: float, spacing: float | None = None, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 32) -> DataFrame:
    """(order, id): start at the largest first part, then again and again the row farthest from those chosen (the smaller
    id on ties), n rows (a fraction below 1), or until the point that brings the largest distance under spacing.

    Rows stay distributed with their distance to the chosen; a turn is one scan and one maximum. The table is written
    every few turns, so that a turn's plan stays short."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("v is not null and size(v) > 0")
    total = rows.count()
    want = total if spacing is not None else min(total, round(n * total) if n < 1 else int(n))
    state = written(rows.withColumn("d", F.lit(float("inf"))))
    first = state.orderBy(F.desc(F.col("v")[0]), "id").first()
    chosen = []
    while first is not None and len(chosen) < want:
        chosen.append((len(chosen) + 1, first["id"]))
        if spacing is not None and len(chosen) > 1 and first["d"] < spacing:
            break
        if len(chosen) == want:
            break
        p = F.array(*map(F.lit, map(float, first["v"])))
        d = F.sqrt(F.aggregate(F.zip_with("v", p, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
        state = state.withColumn("d", F.least("d", d))
        if len(chosen) % every == 0:
            state = written(state)
        first = state.orderBy(F.desc("d"), "id").first()
        if first is not None and first["d"] == 0:
            break
    return df.sparkSession.createDataFrame(chosen, f"`order` int, {id_col} {dict(df.dtypes)[id_col]}")


#: The named palettes.
PALETTES = {
    "sky": ("#f2c13a", "#ef7239", "#f23184", "#955ae8", "#5c96f5"),
    "sea": ("#d9ed92", "#99d98c", "#52b69a", "#168aad", "#1e6091", "#154366", "#0C304C"),
    "cozy": ("#41764c", "#a7c957", "#eadbb3", "#d68b8b", "#bc4749"),
    "fairy": ("#cd92ef", "#ffadcb", "#fed2e2", "#b1e2fc", "#9bc1ff"),
    "winter": ("#007DA3", "#00afb9", "#fdfcdc", "#fdca9b", "#ee6258"),
    "rainbow": ("#f52e2e", "#f5982e", "#f5d42e", "#dcf636", "#acf636", "#36f6a6", "#36e9f6", "#3d90ee", "#7336f6", "#c236f6"),
    "pastel": ("#fcf7b7", "#fed9bb", "#ffbfc3", "#f7aae7", "#c4a6f5", "#90bbf8", "#7cd9f8", "#7beff9", "#85f9e0", "#a4fdac"),
    "candy": ("#9137ff", "#ff5ce4", "#ff4545", "#fee440", "#00bbf9", "#00f5bc"),
    "boring": ("#DEE2E6", "#191C1F"),
}


def rgb(colour: str) -> tuple[int, int, int]:
    return tuple(int(colour[i : i + 2], 16) for i in (1, 3, 5))


def get_pal(name: str | tuple[str, ...] = "rainbow"):
    """A function of n that gives n colours evenly along the named palette, or along given colours, between neighbours by
    linear interpolation."""
    colours = PALETTES.get(name) if isinstance(name, str) else tuple(name)
    if not colours:
        raise ValueError(f"unknown palette: {name}")
    stops = np.array([rgb(c) for c in colours], float)

    def ramp(n: int) -> list[tuple[int, int, int]]:
        at = np.linspace(0, len(stops) - 1, n) if n > 1 else np.zeros(1)
        return [tuple(int(round(float(np.interp(t, np.arange(len(stops)), stops[:, j])))) for j in range(3)) for t in at]

    return ramp


def to_lab(rgb: np.ndarray) -> np.ndarray:
    """sRGB (0-255) to CIE LAB, D65."""
    c = np.asarray(rgb, float) / 255
    c = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    xyz = c @ np.array([[0.4124564, 0.2126729, 0.0193339], [0.3575761, 0.7151522, 0.1191920], [0.1804375, 0.0721750, 0.9503041]]) / np.array([0.95047, 1.0, 1.08883])
    f = np.where(xyz > (6 / 29) ** 3, np.cbrt(xyz), xyz / (3 * (6 / 29) ** 2) + 4 / 29)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], -1)


def choose_colours(near: dict[int, list[int]], crowd: dict[int, float], pal: list[tuple[int, int, int]]) -> dict[int, int]:
    """Colour number of each instance: crowded ones first; of the colours that no neighbour has, the one farthest from
    theirs in LAB. Without coloured neighbours it follows from the id. near: an instance's neighbours; crowd: its mean
    distance to them."""
    lab, n_col = to_lab(np.array(pal)), len(pal)
    apart = np.sqrt(((lab[:, None] - lab[None]) ** 2).sum(-1))
    got: dict[int, int] = {}
    for i in sorted(crowd, key=lambda i: (crowd[i], i)):
        used = sorted({got[j] for j in near.get(i, ()) if j in got})
        free = [c for c in range(n_col) if c not in used] or list(range(n_col))
        got[i] = (i * 2654435761) % n_col if not used else max(free, key=lambda c: (sum(apart[c, u] for u in used), -c))
    return got


def color_ids(df: DataFrame, instance: str = "TreeID", col: str | tuple[str, ...] = "sky", n_col: int = 10, n_neighbors: int = 10, ground_id: int = 0, ground_color: str = "#ffffff", overwrite_rgb: bool = True) -> DataFrame:
    """df with color_ID (1 and up; 0 for the ground) and R, G, B by instance; without overwrite_rgb R, G and B that df
    has stay. Neighbours come from a join on cells; only the table of instances and their neighbours reaches the driver,
    as each choice depends on the ones before it."""
    if instance not in df.columns:
        raise ValueError(f"no attribute {instance}")
    cent = df.where(F.col(instance).isNotNull() & (F.col(instance) != ground_id)).groupBy(F.col(instance).cast("long").alias("id")).agg(F.avg("X").alias("X"), F.avg("Y").alias("Y"), F.min("Z").alias("Z"))
    cent = written(cent)
    box = cent.agg(F.count("*").alias("n"), F.max("X") - F.min("X"), F.max("Y") - F.min("Y")).first()
    near, crowd = {}, {}
    if box.n:
        size = max(1e-3, math.sqrt(max(box[1], 1e-3) * max(box[2], 1e-3) * n_neighbors / box.n))
        rows = knn(cent, n_neighbors, size=size).groupBy("src").agg(F.avg("d").alias("d"), F.collect_list("dst").alias("near")).toLocalIterator()
        for r in rows:
            near[r.src], crowd[r.src] = [j for j in r.near if j != r.src], r.d
    pal = get_pal(col)(n_col)
    colours = choose_colours(near, crowd, pal)
    table = [(i, c + 1, *pal[c]) for i, c in colours.items()] + [(ground_id, 0, *rgb(ground_color))]
    table = df.sparkSession.createDataFrame([tuple(map(int, r)) for r in table], "_i bigint, color_ID int, _R int, _G int, _B int")
    keep = not overwrite_rgb and all(c in df.columns for c in "RGB")
    out = df.drop("color_ID").join(F.broadcast(table) if len(colours) <= SEND else table, F.col(instance).cast("long") == F.col("_i"), "left").drop("_i")
    return out.drop("_R", "_G", "_B") if keep else out.drop("R", "G", "B").withColumnsRenamed({"_R": "R", "_G": "G", "_B": "B"})
