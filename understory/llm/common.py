"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch: a batch of very long texts must fit a Python worker.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: their default of 10,000 rows is far too much for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Unset, it is a temporary one on a single machine, as in
    tests, and an error on a cluster, whose executors couldn't see it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="understory-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Saved:
    """Tables written to the shared folder. Each cuts the lineage and survives lost executors; drop() removes one.

    ``roots`` lists the folders of all instances: who has written what depends on them may remove them (remove())."""

    roots: list[str] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/understory-{uuid.uuid4().hex}", 0
        Saved.roots.append(self.root)

    def __call__(self, df: DataFrame, parts: int | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        (df.coalesce(parts) if parts else df).write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._understory_path = path
        self.sweep()
        return out

    def sweep(self) -> None:
        """Let Spark drop the shuffle files of plans that nothing refers to any more: what they made is written."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        remove(self.spark, *(f._understory_path for f in frames))


def remove(spark: SparkSession, *paths: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def map_texts(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on beside the next stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def columns(df: DataFrame) -> str:
    """The columns of df as a schema text."""
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def spark_words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
