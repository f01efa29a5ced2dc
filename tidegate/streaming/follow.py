"""Exactly-once following of a landing folder, as an alternative to the run ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.sources.tables import Table


def follow(spark: SparkSession, source: str, schema: T.StructType, target: Table, checkpoint: str, keep=None) -> int:
    """Take in what is new under `source` since the last call with this checkpoint, then stop; rows taken in.

    keep, if given, maps each micro-batch to the rows to append. A micro-batch that is tried again after
    a crash overwrites its own partition, so the target, partitioned by `_batch`, has it once.
    """
    taken = 0

    def take(batch: DataFrame, number: int) -> None:
        nonlocal taken
        rows = (keep(batch) if keep else batch).withColumn("_batch", F.lit(number).cast("long"))
        rows = rows.persist()
        taken += rows.count()
        target.overwrite_partitions(rows)
        rows.unpersist()

    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return taken


def windowed_counts(events: DataFrame, at: str, width: str, late: str, *by: str) -> DataFrame:
    """Counts per tumbling window and group over a stream, late rows taken up to `late` behind the newest."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), *by).count().select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "count")
