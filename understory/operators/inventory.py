"""The inventory of trees: counts, heights, vote, medians, scores, hulls, and the summary of a stand."""

from __future__ import annotations

import math
import re
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import geojson_polygon, in_polygons, non_negative, quality_label, ring_area
from ..model import Config, ConfigError
from ..plans.storage import written
from .circle import DBH, simple_diameters, tree_diameters
from .hull import hull_vertices
from .voxel import grid_thin

TREE = ("segmentation_source", "instance_dimension", "instance_id")


def tree_counts(seg: DataFrame) -> DataFrame:
    return seg.groupBy(*TREE).agg(F.count("*").alias("point_count"))


def tree_geometry(seg: DataFrame) -> DataFrame:
    """Count, height range and mean place of each tree: one shuffle of partial aggregates."""
    return seg.groupBy(*TREE).agg(F.count("*").alias("point_count"), (F.max("Z") - F.min("Z")).alias("height_m"), F.median("X").alias("x"), F.median("Y").alias("y"), F.min("Z").alias("z"))


def species_vote(seg: DataFrame) -> DataFrame:
    """Commonest species (the smallest on ties), the exact median of its points' probabilities, and the share of the others."""
    votes = seg.select(*TREE, non_negative(F.col("species")).alias("sp"), non_negative(F.col("prob")).alias("p")).where("sp is not null")
    counts = votes.groupBy(*TREE, "sp", "p").agg(F.count("*").alias("n"))
    by_species = counts.groupBy(*TREE, "sp").agg(F.sum("n").alias("votes"), F.percentile("p", F.lit(0.5), F.coalesce("n", F.lit(1))).alias("p50"))
    best = by_species.groupBy(*TREE).agg(F.max(F.struct("votes", -F.col("sp"), "p50")).alias("b"), F.sum("votes").alias("total"))
    return best.select(*TREE, (-F.col("b.col2")).alias("species_id"), F.col("b.p50").alias("species_prob"), (1 - F.col("b.votes") / F.col("total")).alias("species_conflict_fraction"))


def score_histogram(seg: DataFrame) -> DataFrame:
    """JSON of (score, point_count), commonest first, then the smaller score; NULL without scores."""
    counts = seg.select(*TREE, non_negative(F.col("score")).alias("score")).where("score is not null").groupBy(*TREE, "score").agg(F.count("*").alias("n"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "score", "n")))
    return counts.groupBy(*TREE).agg(F.to_json(F.transform(rows, lambda r: F.struct(r["score"].alias("score"), r["n"].alias("point_count")))).alias("pred_score_values"))


def weighted_median(df: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Exact median from counts of values: the mean of the two middle ones."""
    return df.groupBy(*keys, value).agg(F.count("*").alias("n")).where(F.col(value).isNotNull()).groupBy(*keys).agg(F.percentile(value, F.lit(0.5), F.col("n")).alias("median"))


def hull_areas(seg: DataFrame, min_height: float = 0.5) -> DataFrame:
    """Crown hull over the points above min_height: ring, area (NULL under three vertices) and GeoJSON."""
    h = hull_vertices(seg.where(F.col("Z") > min_height).select(*TREE, "X", "Y"), TREE)
    return h.select(*TREE, "ring", ring_area(F.col("ring")).alias("convex_hull_area_m2"), F.when(F.size("ring") >= 3, geojson_polygon(F.col("ring"))).alias("crown_hull"))


def thinned_geometry(thin: DataFrame, zref: str) -> DataFrame:
    """Of the thinned points of each tree: their number, height range, median place and lowest original height."""
    return thin.groupBy(*TREE).agg(F.count("*").cast("int").alias("metrics_point_count"), (F.max("Z") - F.min("Z")).alias("height_m"), F.median("X").alias("mx"), F.median("Y").alias("my"), F.min(zref).alias("mz"), F.count_if(F.col("Z") > 0.5).alias("crown"))


COLUMNS = (
    *TREE, "x", "y", "z", "dbh_m", "height_m", "convex_hull_area_m2", "point_count", "metrics_point_count", "species_id", "species_prob", "species_conflict_fraction",
    "pred_score_values", "dbh_quality_code", "dbh_quality_label", "dbh_runs", "dbh_runs_fitted", "dbh_spread_m", "dbh_band_points", "dbh_fits", "dbh_slices", "crown_hull",
)


def inventory(seg: DataFrame, cfg: Config, with_dbh: bool = True) -> DataFrame:
    """One row for each tree. seg: the unpivoted cloud with Z as height over ground (Zref: the old Z, if there).

    Counts, votes and scores are of all points; everything else is of the points thinned to cfg.metrics_grid, which are
    written once. Position: the measurement's, else the thinned points' median place and lowest height. A tree without a
    point in the band or above 0.5 m, and one whose measurement fails, has code 9; one with under three points above 0.5 m
    has the hull of all its points. Parts are joined on the tree, a table of trees. Evidence columns are JSON and NULL
    where nothing was measured."""
    zref = "Zref" if "Zref" in seg.columns else "Z"
    thin = written(grid_thin(seg.select(*TREE, "X", "Y", "Z", *([zref] if zref != "Z" else [])), cfg.metrics_grid, TREE, z=zref).select(*TREE, "X", "Y", "Z", *([zref] if zref != "Z" else [])))
    geometry = written(thinned_geometry(thin, zref))
    low = geometry.where("crown < 3").select(*TREE)
    hulls = hull_areas(thin.join(low, [*TREE], "left_anti")).unionByName(hull_areas(thin.join(low, [*TREE], "left_semi"), -math.inf))
    out = geometry.join(tree_counts(seg), [*TREE]).join(species_vote(seg), [*TREE], "left").join(score_histogram(seg), [*TREE], "left").join(hulls, [*TREE], "left")
    dbh = {n: t for n, t in (d.split(" ", 1) for d in re.split(r", (?=dbh)", DBH)[1:])}
    if with_dbh:
        m = tree_diameters(thin, cfg).join(geometry.where("crown > 0").select(*TREE), [*TREE], "left_semi")
        out = out.join(m, [*TREE], "left")
    else:
        out = out.withColumns({c: F.lit(None).cast(t) for c, t in dbh.items()})
    out = out.withColumns({"x": F.coalesce("dbh_x", "mx"), "y": F.coalesce("dbh_y", "my"), "z": F.coalesce("dbh_z", "mz"), "dbh_quality_code": F.coalesce("dbh_quality_code", F.lit(9)), "dbh_band_points": F.coalesce("dbh_band_points", F.lit(0)).cast("double")})
    out = out.withColumn("dbh_quality_label", quality_label(F.col("dbh_quality_code"), F.col("dbh_m")))
    return out.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in ("dbh_fits", "dbh_slices")}).select(*COLUMNS)


def _of_trees(points: DataFrame, tree: str, non_tree: tuple[int, ...], rest: list[str] = ()) -> DataFrame:
    """The points of trees, Z as height over ground: by Zref if there, else by Znorm."""
    if tree not in points.columns:
        raise ConfigError(f"no attribute {tree}")
    if "Zref" not in points.columns:
        if "Znorm" not in points.columns:
            raise ConfigError("heights over ground are needed: Zref (with Z normalised) or Znorm")
        points = points.withColumn("Zref", F.col("Z")).withColumn("Z", F.col("Znorm"))
    keep = [c for c in ("Planarity", "Verticality", *rest) if c in points.columns]
    out = points.where(F.col(tree).isNotNull() & ~F.col(tree).isin(*non_tree)) if non_tree else points.where(F.col(tree).isNotNull())
    return out.select(F.lit("").alias("segmentation_source"), F.lit(tree).alias("instance_dimension"), F.col(tree).cast("long").alias("instance_id"), "X", "Y", "Z", "Zref", *keep)


def _heights_and_hulls(p: DataFrame) -> DataFrame:
    """Only trees with points above 0.5 m, as a hull is joined to each."""
    heights = p.groupBy(*TREE).agg((F.max("Z") - F.min("Z")).alias("Height"))
    return heights.join(hull_areas(p).select(*TREE, F.col("convex_hull_area_m2").alias("ConvexHullArea")), [*TREE])


def forest_inventory(
    points: DataFrame, slice_min: float = 0.3, slice_max: float = 4.0, increment: float = 0.2, width: float = 0.1, max_dbh: float = 1.0, tree_id_col: str = "TreeID", non_tree_id: tuple[int, ...] = (0,),
    use_stem_segmentation: bool = False, semantic_colname: str | None = None, stem_semantic_label: int | None = None, return_evidence: bool = False, random_seed: int = 42,
) -> DataFrame:
    """(tree id, X, Y, Z, DBH, quality_flag, Height, ConvexHullArea, and dbh_slices with return_evidence) of segmented
    points with heights. One run of the taper curve for each tree. With stem segmentation only points of the semantic
    class are fitted, and all of them."""
    if width > increment / 2:
        raise ConfigError("slices may not overlap: width is at most half of increment")
    cfg = replace(Config(), slice_min=slice_min, slice_max=slice_max, slice_increment=increment, slice_width=width, max_dbh=max_dbh, dbh_runs=1, random_seed=random_seed)
    if use_stem_segmentation and (semantic_colname is None or stem_semantic_label is None or semantic_colname not in points.columns):
        raise ConfigError("stem segmentation needs semantic_colname, an attribute of the points, and stem_semantic_label")
    p = _of_trees(points, tree_id_col, non_tree_id, [semantic_colname] if use_stem_segmentation else [])
    band = p
    if use_stem_segmentation:  # no geometry filter: features without a value
        band = p.where(F.col(semantic_colname) == stem_semantic_label).withColumns({"Planarity": F.lit(None).cast("double"), "Verticality": F.lit(None).cast("double")})
    found = tree_diameters(band, cfg, strict=True).join(_heights_and_hulls(p), [*TREE])
    extra = ["dbh_slices"] if return_evidence else []
    return found.select(F.col("instance_id").alias(tree_id_col), F.col("dbh_x").alias("X"), F.col("dbh_y").alias("Y"), F.col("dbh_z").alias("Z"), F.col("dbh_m").alias("DBH"), F.col("dbh_quality_code").alias("quality_flag"), "Height", "ConvexHullArea", *extra)


def forest_inventory_simple(points: DataFrame, slice_min: float = 1.2, slice_max: float = 1.4, max_dbh: float = 1.0, random_seed: int = 42) -> DataFrame:
    """(TreeID, X, Y, DBH, quality_flag, Height, ConvexHullArea, Z): one circle over one slice; Z is the slice's mean
    difference of height over ground and original height. max_dbh is taken for the call's sake: diameters end at 2 m."""
    p = _of_trees(points, "TreeID", ()).where("instance_id > 0")
    one = simple_diameters(p.withColumn("TreeID", F.col("instance_id")), slice_min, slice_max, random_seed)
    z = p.where((F.col("Z") > slice_min) & (F.col("Z") < slice_max)).groupBy(F.col("instance_id").alias("TreeID")).agg(F.avg(F.col("Zref") - F.col("Z")).alias("Z"))
    rest = _heights_and_hulls(p).select(F.col("instance_id").alias("TreeID"), "Height", "ConvexHullArea")
    return one.join(rest, "TreeID").join(z, "TreeID")


def with_species_names(inv: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on source and species; trees without an entry keep their row."""
    keys = [c for c in ("segmentation_source", "species_id") if c in lookup.columns]
    return inv.join(lookup, keys, "left").select(*inv.columns, *[c for c in lookup.columns if c not in keys])


def in_area(inv: DataFrame, polygons: list[list[list[tuple[float, float]]]]) -> DataFrame:
    """Trees whose position lies in one of the polygons, and in none of its holes."""
    return inv.where(in_polygons(F.col("x"), F.col("y"), polygons))


def stand_summary(inv: DataFrame, area_m2: float) -> DataFrame:
    """For each segmentation: counts, coverage, trees and basal area a hectare (NULL unless every tree is measured),
    mean, median and quantiles of diameter and height."""
    stats = []
    for c, n in (("dbh_m", "dbh"), ("height_m", "height")):
        stats += [F.avg(c).alias(f"mean_{n}_m"), F.median(c).alias(f"median_{n}_m"), *[F.percentile(c, F.lit(q / 100)).alias(f"p{q:02d}_{n}_m") for q in (5, 25, 75, 95)]]
    basal = F.sum(F.lit(math.pi / 4) * F.col("dbh_m") * F.col("dbh_m")) * 10_000 / area_m2
    return inv.groupBy("segmentation_source", "instance_dimension").agg(
        F.count("*").alias("tree_count"), F.count("dbh_m").alias("dbh_measured_count"), (F.count("dbh_m") / F.count("*")).alias("dbh_coverage_fraction"), F.lit(area_m2).alias("stand_area_m2"),
        (F.count("*") * 10_000 / area_m2).alias("trees_per_ha"), F.when(F.count("dbh_m") == F.count("*"), basal).alias("basal_area_m2_ha"), *stats,
    )


def instance_index(seg: DataFrame, scale: float = 0.001) -> DataFrame:
    """Count, integer extent and integer sums of each instance; sums are decimals, as they may pass 2^63."""
    i = {c: F.round(F.col(c) / scale).cast("long") for c in "XYZ"}
    return seg.groupBy(*TREE).agg(F.count("*").alias("n"), *[f(i[c]).alias(f"{n}_{c.lower()}") for c in "XYZ" for n, f in (("min", F.min), ("max", F.max))], *[F.sum(i[c].cast("decimal(38,0)")).alias(f"sum_{c.lower()}") for c in "XY"])


def owner_core(index: DataFrame, size: float, scale: float = 0.001) -> DataFrame:
    """The core square that owns each instance: by its centroid, from the smallest extent on."""
    c = index.withColumns({f"c{a}": F.col(f"sum_{a}").cast("double") / F.col("n") * scale for a in "xy"})
    o = index.agg(F.min("min_x").alias("_ox"), F.min("min_y").alias("_oy"))
    return c.crossJoin(F.broadcast(o)).select(*TREE, "n", F.floor((F.col("cx") - F.col("_ox") * scale) / size).cast("long").alias("core_x"), F.floor((F.col("cy") - F.col("_oy") * scale) / size).cast("long").alias("core_y"))


def owned_rows(seg: DataFrame, owners: DataFrame) -> DataFrame:
    """Rows whose instance is among the owners: a semi join."""
    return seg.join(owners.select(*TREE), [*TREE], "left_semi")


def last_by(df: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
