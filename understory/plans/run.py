"""Whole runs: the inventory of a cloud, with or without the shortest-path segmentation, to published tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import crs
from ..functions.scalar import polygons_area, utm_to_wgs84
from ..model import Config, ConfigError, SegmentationSpec, parse_args
from ..operators.features import add_geometry
from ..operators.graph import assign_back, csp_cost_segmentation, find_base_coordinates_raster
from ..operators.hull import hull_vertices
from ..operators.inventory import in_area, inventory, stand_summary, with_species_names
from ..operators.terrain import make_dtm, normalise_height, read_dtm
from ..sources import output
from ..sources.points import check_seeds, read_aoi, read_lookup, read_points, read_seeds, unpivot
from .storage import written

#: Rows up to which a table of seeds goes to all tasks.
SEND = 1_000_000


def run_csp(points: DataFrame, cfg: Config, seeds: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(points with PredInstance_CSP, seeds). Features are made only if a weight asks for them; points that no path
    reaches get 0. At least two seeds are needed."""
    seeds = find_base_coordinates_raster(points, cfg.seed_resolution, cfg.seed_z_min, cfg.seed_z_max, cfg.seed_quantile, cfg.seed_eps) if seeds is None else check_seeds(seeds)
    seeds = written(seeds)
    if seeds.count() < 2:
        raise ConfigError("the segmentation needs at least two seeds")
    numbered = written(points.withColumn("point_id", F.xxhash64(*points.columns)))
    work = numbered.select("point_id", "X", "Y", "Z").dropDuplicates(["point_id"])
    if cfg.verticality_weight or cfg.linearity_weight or cfg.sphericity_weight:
        work = add_geometry(work, cfg.geometry_k, "point_id", cfg.voxel_resolution)
    found = csp_cost_segmentation(work, seeds, cfg.voxel_resolution, cfg.verticality_weight, cfg.linearity_weight, cfg.sphericity_weight)
    return assign_back(numbered, written(found.select("point_id", "TreeID"))).drop("point_id"), seeds


def stand_area(points: DataFrame, cfg: Config) -> float:
    """Of the area of interest if given (holes left out, overlaps counted once), else of the hull of all points."""
    if cfg.stand_area_m2:
        return cfg.stand_area_m2
    if cfg.aoi:
        return polygons_area(cfg.aoi)
    row = hull_vertices(points, ()).first()
    return polygons_area([[[(p.x, p.y) for p in row.ring]]]) if row else 0.0


def inventory_from_points(points: DataFrame, cfg: Config, dtm: DataFrame | None = None, seeds: DataFrame | None = None, made: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(inventory, summary) of a cloud in original heights. A point without terrain stops the run.

    made: gets what the run made on the way, by name: terrain, and with the segmentation seeds and cloud (in original heights)."""
    cfg.validate()
    dtm = written(make_dtm(points, cfg.dtm_resolution, candidate=cfg.dtm_candidate_resolution)) if dtm is None else dtm
    norm, specs = normalise_height(points, dtm, cfg.dtm_resolution), cfg.specs
    made = {} if made is None else made
    made["terrain"] = dtm
    used = None
    if cfg.enable_csp:
        norm, used = run_csp(norm, cfg, seeds)
        norm = written(norm)
        specs = (*specs, SegmentationSpec("PredInstance_CSP"))
        made |= {"seeds": used, "cloud": norm.withColumn("Z", F.col("Zref")).drop("Zref")}
    inv = inventory(unpivot(norm, specs, ("X", "Y", "Z", "Zref")), cfg)
    if not cfg.dbh_evidence:
        inv = inv.drop("dbh_fits", "dbh_slices", "crown_hull")
    if used is not None:
        s = used.select(F.lit("PredInstance_CSP").alias("instance_dimension"), F.col("TreeID").alias("instance_id"), F.col("X").alias("seed_x"), F.col("Y").alias("seed_y"), F.col("Z").alias("seed_height_m"))
        inv = inv.join(F.broadcast(s) if s.count() <= SEND else s, ["instance_dimension", "instance_id"], "left").select(*inv.columns[:6], "seed_x", "seed_y", "seed_height_m", *inv.columns[6:])
    if cfg.aoi:
        inv = in_area(inv, cfg.aoi)
    inv = written(inv)
    return inv, stand_summary(inv, stand_area(points, cfg))


def input_stamp(spark: SparkSession, path: str) -> tuple:
    """Number, bytes and a hash of names, lengths and times of a path's files; no content is read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    return tuple(f.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def run(spark: SparkSession, args: list[str], epsg: int | None = None) -> str:
    """Command-line style: options to a published folder of tables and a manifest: the inventory and the summary, the
    terrain if the run made it, the segmented cloud with the segmentation, and with --debug-outputs the effective seeds
    and a record of the run."""
    paths, cfg = parse_args(args)
    before = input_stamp(spark, paths["input"])
    fmt = "las" if paths["input"].lower().endswith(".las") else "parquet"
    if fmt == "las":
        from ..sources.las import LasSource, read_header, resolve

        spark.dataSource.register(LasSource)
        systems = [w for w in (read_header(p)["wkt"] for p in resolve(paths["input"])) if w]
        if any(not crs.same_horizontal(crs.require_metric(w), systems[0]) for w in systems):
            raise ConfigError("the files differ in their coordinate system")
        epsg = epsg or (crs.epsg(systems[0]) if systems else None)
    if cfg.enable_csp:  # the segmented cloud keeps every attribute
        every = spark.read.format(fmt).load(paths["input"])
        if "PredInstance_CSP" in every.columns:
            raise ConfigError("the input already has PredInstance_CSP")
        points = read_points(spark, paths["input"], cfg.specs, tuple(c for c in every.columns if c != "Zref"), fmt=fmt)
    else:
        points = read_points(spark, paths["input"], cfg.specs, fmt=fmt)
    if "aoi-json" in paths:
        cfg = replace(cfg, aoi=tuple(read_aoi(spark, paths["aoi-json"])))
    dtm = read_dtm(spark, paths["dtm"], points, cfg.dtm_resolution) if "dtm" in paths else None
    made: dict = {}
    inv, summary = inventory_from_points(points, cfg, dtm, read_seeds(spark, paths["seed-file"]) if "seed-file" in paths else None, made)
    if epsg and (32601 <= epsg <= 32660 or 32701 <= epsg <= 32760):
        lon, lat = utm_to_wgs84(F.col("x"), F.col("y"), epsg)
        inv = inv.withColumns({"longitude": lon, "latitude": lat})
    if epsg:
        summary = summary.withColumn("crs", F.lit(f"EPSG:{epsg}"))
    if "species-lookup" in paths:
        inv = with_species_names(inv, read_lookup(spark, paths["species-lookup"]))
    target = paths["output-dir"].rstrip("/")
    staged = f"{target}.staging-{uuid.uuid4().hex[:8]}"
    tables = {"tree_inventory": f"{staged}/tree_inventory.parquet", "stand_summary": f"{staged}/stand_summary.parquet"}
    output.write_parquet(inv, tables["tree_inventory"])
    output.write_csv(inv, f"{staged}/tree_inventory.csv")
    output.write_csv(summary, f"{staged}/stand_summary.csv")
    summary.coalesce(1).write.parquet(tables["stand_summary"])
    if dtm is None:
        tables["terrain"] = f"{staged}/terrain.parquet"
        made["terrain"].write.parquet(tables["terrain"])
    if "cloud" in made:
        tables["segmented_points"] = f"{staged}/segmented_points.parquet"
        made["cloud"].write.parquet(tables["segmented_points"])
    if cfg.debug_outputs:
        if "seeds" in made:
            output.write_csv(made["seeds"].select("X", "Y", "Z", "TreeID"), f"{staged}/effective_seeds.tsv", sep="\t")
        output.write_json(spark, f"{staged}/run.json", {"options": {k: v for k, v in vars(cfg).items() if k not in ("specs", "aoi")}, "paths": paths, "segmentations": [s.instance for s in cfg.specs], "terrain_supplied": dtm is not None, "points": points.count(), "trees": inv.count()})
    m = output.manifest(spark, tables, f"EPSG:{epsg}" if epsg else None)
    output.check_manifest(spark, m, staged)
    if input_stamp(spark, paths["input"]) != before:
        raise ConfigError("the input changed during the run; nothing is published")
    output.write_json(spark, f"{staged}/manifest.json", m)
    output.publish(spark, staged, target)
    return target
