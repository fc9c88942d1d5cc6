"""Micro-batch accumulation: the inventory's aggregates over a stream of points. An extension; batches give what one
batch gives, as all state is counts, sums, minima and maxima."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import shared_folder


def read_stream(spark: SparkSession, path: str, schema, per_trigger: int = 4) -> DataFrame:
    """Parquet files as a stream, a few files a trigger: that bounds what is in flight."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def accumulate(points: DataFrame, keys: tuple[str, ...] = ("instance_id",), value: str = "Z") -> DataFrame:
    """Count, range and sum by key; the state store keeps one row a key."""
    return points.groupBy(*keys).agg(F.count("*").alias("point_count"), (F.max(value) - F.min(value)).alias("height_m"), F.min(value).alias("low"), F.max(value).alias("high"))


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Event-time windows by type; rows later than the watermark are left out by Spark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def distinct_points(points: DataFrame, key: str = "event_id", time: str = "ts", late: str = "1 day") -> DataFrame:
    """A point that comes again within the watermark counts once."""
    return points.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run_available(df: DataFrame, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Work off what is there, then stop; the result as a written table. Nothing of it passes the driver: each batch is
    written to the shared folder, of a complete result the last one counts, of appended rows all."""
    spark, folder, seen = df.sparkSession, f"{shared_folder(df.sparkSession)}/understory-{uuid.uuid4().hex}", []

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{number}")
        seen.append(number)

    q = df.writeStream.outputMode(mode).foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", checkpoint or f"{folder}-state").start()
    q.awaitTermination()
    paths = [f"{folder}/{n}" for n in sorted(set(seen))]
    if not paths:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(*(paths[-1:] if mode == "complete" else paths))
