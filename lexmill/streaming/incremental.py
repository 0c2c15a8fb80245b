"""Runs over what is new: changed shards, and files of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill.operators.joins import inventory_diff
from lexmill.sources import files


def changed_shards(before: DataFrame | None, now: DataFrame) -> DataFrame:
    """``shard_key`` and whether it was added, removed, changed or is unchanged."""
    if before is None:
        return now.select("shard_key", F.lit("added").alias("status"))
    return inventory_diff(before, now, "shard_key", "state")


def write_shards(rows: DataFrame, path: str, shard: str = "shard_key") -> None:
    """Replace the partitions of the shards in the rows and leave all others."""
    rows.write.partitionBy(shard).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def run_available(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Put files that have come since the last run through ``transform``, each batch once.

    A batch has a folder of its own, so one that is run again after a failure
    replaces what it had written.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number:06d}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_batches(spark: SparkSession, target: str) -> DataFrame | None:
    """All batches written so far."""
    return spark.read.parquet(target) if files.exists(spark, target) else None


def windowed_counts(events: DataFrame, *, time: str = "ts", kind: str = "event_type", value: str = "value", late: str = "10 minutes", length: str = "1 hour") -> DataFrame:
    """Counts and sums by window and kind; rows later than ``late`` are left out of a stream's result."""
    return events.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")
