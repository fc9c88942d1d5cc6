"""Sinks: ordered Parquet and CSV tables, manifest, all-or-nothing publishing."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("instance_dimension", "instance_id")
UNITS = {"x": "m", "y": "m", "z": "m", "dbh_m": "m", "height_m": "m", "convex_hull_area_m2": "m2", "dbh_spread_m": "m", "longitude": "degree", "latitude": "degree", "species_prob": "1", "species_conflict_fraction": "1"}


def ordered(df: DataFrame) -> DataFrame:
    """Strings by bytes, then ids; seeds by their tree."""
    keys = [k for k in (*KEYS, "TreeID") if k in df.columns]
    return df.orderBy(*keys) if keys else df


def with_units(df: DataFrame) -> DataFrame:
    """Units as column metadata; they stay in the Parquet schema."""
    return df.select(*[F.col(c).alias(c, metadata={"unit": UNITS[c]}) if c in UNITS else F.col(c) for c in df.columns])


def write_parquet(df: DataFrame, path: str, single: bool = True, rows: int = 2048) -> None:
    """Row groups of at most 2,048 rows. An inventory is one row a tree, so one file is the default."""
    out = ordered(with_units(df))
    (out.coalesce(1) if single else out).write.option("compression", "snappy").option("parquet.block.row.count.limit", rows).parquet(path)


def csv_text(df: DataFrame) -> DataFrame:
    """15 significant digits, TRUE and FALSE, empty for NULL."""
    short = lambda c: F.regexp_replace(F.regexp_replace(F.format_string("%.15g", F.col(c)), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return df.select(*[F.upper(F.col(c).cast("string")).alias(c) if t == "boolean" else F.when(F.col(c) == F.floor(c), F.col(c).cast("decimal(38,0)").cast("string")).when(F.col(c).isNotNull(), short(c)).alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, single: bool = True, sep: str = ",") -> None:
    out = csv_text(ordered(df))
    (out.coalesce(1) if single else out).write.option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "").option("emptyValue", '""').option("sep", sep).csv(path)


def manifest(spark: SparkSession, tables: dict[str, str], crs: str | None = None) -> dict:
    """Rows and columns of each written table, counted from what was written."""
    out = {"format_version": 1, "crs": crs, "tables": []}
    for name, path in sorted(tables.items()):
        df = spark.read.parquet(path)
        out["tables"].append({"name": name, "path": path.rsplit("/", 1)[-1], "rows": df.count(), "columns": [{"name": c, "type": t} for c, t in df.dtypes]})
    return out


def check_manifest(spark: SparkSession, m: dict, folder: str) -> None:
    for t in m["tables"]:
        df = spark.read.parquet(f"{folder}/{t['path']}")
        if df.count() != t["rows"] or [{"name": c, "type": k} for c, k in df.dtypes] != t["columns"]:
            raise ValueError(f"the manifest doesn't fit table {t['name']}")


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a finished folder to its place; it must not exist or be empty. Works on any Hadoop file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(conf)
    if fs.exists(dst):
        if len(fs.listStatus(dst)):
            raise FileExistsError(f"{target} isn't empty")
        fs.delete(dst, False)
    if dst.getParent() is not None:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"can't rename {staged} to {target}")


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """A small document, through the path's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).create(p, True)
    out.write(bytearray(json.dumps(value, indent=2, sort_keys=True).encode()))
    out.close()
