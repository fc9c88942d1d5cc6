"""Point tables: reading, schema checks, merging, validity, and the adapter views over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import finite
from ..model import STANDARD, ConfigError, SegmentationSpec


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing attributes stop a run before any scan; they never become NULL."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ConfigError(f"missing attributes: {', '.join(missing)}")
    return df


def read_points(spark: SparkSession, paths: str | list[str], specs: tuple[SegmentationSpec, ...] = (), extra: tuple[str, ...] = (), fmt: str = "parquet") -> DataFrame:
    """Coordinates and the attributes that the specs name, and no others: the scan reads those columns alone."""
    df = spark.read.format(fmt).load(paths)
    want = list(dict.fromkeys(["X", "Y", "Z", *(c for s in specs for c in s.columns), *extra]))
    return require(df, want).select(*[F.col(c).cast(STANDARD[c]).alias(c) if c in STANDARD else F.col(c) for c in want])


def spatial_filter(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Half-open tile core; pushed down to Parquet statistics."""
    return df.where((F.col("X") >= xmin) & (F.col("X") < xmax) & (F.col("Y") >= ymin) & (F.col("Y") < ymax))


def bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c.lower()}") for c in ("X", "Y", "Z") for f, n in ((F.min, "min"), (F.max, "max"))])


def add_las_attributes(df: DataFrame) -> DataFrame:
    """Keep what can be stored with a point: standard attributes and every further numeric one, as double."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    return df.select(*[F.col(c).cast(STANDARD[c]).alias(c) if c in STANDARD else F.col(c).cast("double").alias(c) for c, t in df.dtypes if c in STANDARD or t in numeric or t.startswith("decimal")])


def merge(clouds: list[DataFrame], fill: bool = False, oci: bool = True, crs: list[str | None] | None = None) -> DataFrame:
    """Stack clouds: their common columns, or (fill) all columns with NULL; oci numbers the cloud a point comes from."""
    if not clouds or any(not isinstance(c, DataFrame) for c in clouds):
        raise ConfigError("clouds are DataFrames")
    known = {c for c in crs or [] if c}
    if len(known) > 1:
        raise ConfigError(f"clouds differ in their coordinate system: {sorted(known)}")
    for c in clouds:
        require(c, ["X", "Y", "Z"])
    common = [c for c in clouds[0].columns if all(c in o.columns for o in clouds)]
    parts = [(c if fill else c.select(*common)).withColumns({"oci": F.lit(i)} if oci else {}) for i, c in enumerate(clouds, 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=fill)
    return out


def valid_instance(instance: Column, non_tree: tuple[int, ...] = (0,)) -> Column:
    """Finite, not negative and not a non-tree id."""
    v = finite(instance)
    return F.coalesce((v >= 0) & ~v.isin([float(i) for i in non_tree]) if non_tree else v >= 0, F.lit(False))


def unpivot(df: DataFrame, specs: tuple[SegmentationSpec, ...], keep: tuple[str, ...] = ("X", "Y", "Z")) -> DataFrame:
    """One row for each point and segmentation with a valid instance: a single scan feeds all segmentations."""
    require(df, [*keep, *(c for s in specs for c in s.columns)])
    one = lambda s: F.struct(F.lit(s.label).alias("segmentation_source"), F.lit(s.instance).alias("instance_dimension"), F.when(valid_instance(F.col(s.instance), s.non_tree_ids), safe_id(F.col(s.instance))).alias("instance_id"), *[(F.col(c).cast("double") if c else F.lit(None).cast("double")).alias(n) for c, n in ((s.species, "species"), (s.probability, "prob"), (s.score, "score"))])
    out = df.select(*keep, F.explode(F.array(*map(one, specs))).alias("_s")).select(*keep, "_s.*")
    return out.where("instance_id is not null")


def safe_id(instance: Column) -> Column:
    """As BIGINT; an id that isn't a whole number up to 2^53 is an error."""
    ok = (F.floor(instance.cast("double")) == instance) & (F.abs(instance) <= 2**53)
    return F.when(instance.isNull() | ok, instance.cast("long")).otherwise(F.raise_error(F.lit("instance ids must be whole numbers up to 2^53")).cast("long"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed table (tab-separated X, Y, Z, TreeID); ids must be distinct, positive and whole."""
    df = require(spark.read.csv(path, sep="\t", header=True, schema="X double, Y double, Z double, TreeID double"), ["X", "Y", "Z", "TreeID"])
    return check_seeds(df)


def check_seeds(df: DataFrame) -> DataFrame:
    bad = df.agg(F.count("*").alias("n"), F.countDistinct("TreeID").alias("d"), F.count_if(F.expr("X is null or Y is null or Z is null or TreeID is null or TreeID <= 0 or TreeID <> floor(TreeID)")).alias("bad")).first()
    if not bad.n or bad.d != bad.n or bad.bad:
        raise ConfigError("seeds need finite X, Y, Z and distinct positive whole TreeIDs")
    return df.withColumn("TreeID", F.col("TreeID").cast("long"))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Species lookup: segmentation_source and species_id name a row once; no blanks."""
    df = require(spark.read.csv(path, header=True), ["segmentation_source", "species_id", "scientific_name"])
    bad = df.agg(F.count("*").alias("n"), F.countDistinct("segmentation_source", "species_id").alias("d"), F.count_if(F.expr("coalesce(trim(scientific_name), '') = ''")).alias("b")).first()
    if bad.n != bad.d or bad.b:
        raise ConfigError("the lookup has blanks or repeats a species")
    return df.withColumn("species_id", F.col("species_id").cast("double"))


def read_aoi(spark: SparkSession, path: str) -> list[list[list[tuple[float, float]]]]:
    """The (multi)polygons of a GeoJSON file as lists of rings, the outer one and its holes; other geometries are an error."""
    import json

    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file

    def geometries(x):
        if x.get("type") == "FeatureCollection":
            return [g for f in x["features"] for g in geometries(f)]
        if x.get("type") == "GeometryCollection":
            return [g for f in x["geometries"] for g in geometries(f)]
        return geometries(x["geometry"]) if x.get("type") == "Feature" else [x]

    out = []
    for g in geometries(json.loads(text)):
        if g["type"] not in ("Polygon", "MultiPolygon"):
            raise ConfigError("the area of interest must hold polygons")
        for poly in [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]:
            rings = [[(float(p[0]), float(p[1])) for p in r] for r in poly]
            out.append([r[:-1] if r[0] == r[-1] else r for r in rings])
    if not out:
        raise ConfigError("the area of interest is empty")
    return out


# adapter views over the driver's tables


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a point cloud with two segmentations."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select(
        F.col("l_quantity").cast("double").alias("X"), (F.col("l_extendedprice").cast("double") / 2000).alias("Y"), F.round(F.col("l_discount").cast("double") * 100).alias("Z"),
        F.col("l_suppkey").cast("long").alias("tree_a"), F.col("l_linenumber").cast("long").alias("tree_b"), F.col("l_linenumber").cast("double").alias("species"),
        F.col("l_tax").cast("double").alias("prob"), F.col("l_discount").cast("double").alias("score"), F.col("l_orderkey").alias("okey"), F.col("l_partkey").alias("pkey"),
    )


SPECS = (SegmentationSpec("tree_a", "species", "prob", "score", source="A"), SegmentationSpec("tree_b", "species", "prob", "score", source="B"))
PTS_SQL = "pts as (select l_quantity::double as X, l_extendedprice::double / 2000 as Y, round(l_discount::double * 100) as Z, l_suppkey::bigint as tree_a, l_linenumber::bigint as tree_b, l_linenumber::double as species, l_tax::double as prob, l_discount::double as score, l_orderkey as okey, l_partkey as pkey from lineitem)"
SEG_SQL = PTS_SQL + ", seg as (select 'A' as src, 'tree_a' as dim, tree_a as id, * from pts where tree_a > 0 union all select 'B', 'tree_b', tree_b, * from pts where tree_b > 0)"


def seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot(pts(spark, sf_dir), SPECS)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").cast("long").alias("species_id"), F.col("n_name").alias("scientific_name"))


def stems(spark: SparkSession, trees: int = 4, points: int = 2400) -> DataFrame:
    """Noisy cylinders with a known radius of 0.1 + 0.05 * tree, made from range and hashes."""
    n = F.col("id") % points
    tree = F.floor(F.col("id") / points) + 1
    noise = lambda salt: (F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(10_000)) / 10_000.0 - 0.5) * 0.004
    a = F.radians((n % 120).cast("double") * 3)
    r = F.lit(0.1) + F.lit(0.05) * tree
    return spark.range(trees * points).select((tree * 10 + r * F.cos(a) + noise(1)).alias("X"), (tree * 5 + r * F.sin(a) + noise(2)).alias("Y"), (F.floor(n / 120) * 0.2 + F.pmod(F.xxhash64("id"), F.lit(100)) * 0.001 + 0.3).alias("Z"), tree.cast("long").alias("instance_id"))
