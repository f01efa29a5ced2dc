"""Effective-dated versions and lookups into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIRST, OPEN = "1900-01-01 00:00:00", "9999-12-31 00:00:00"


def scd2(df: DataFrame, key: str, tracked: Sequence[str], at: str, *tie: Column) -> DataFrame:
    """Versions of the tracked columns: key, tracked, valid_from, valid_to (exclusive), is_current.

    Rows that repeat the version before are dropped, comparing null-safely so a null that moves between
    columns is a change. The first version is valid from 1900; the last one is open. Versions of no
    length, from changes at one time, are dropped, and the last of them stands.
    """
    order = Window.partitionBy(key).orderBy(F.col(at), *tie)
    values = F.struct(*tracked)
    seen = df.withColumn("_before", F.lag(values).over(order)).withColumn("_n", F.row_number().over(order)).withColumn("_next", F.lead(at).over(order))
    seen = seen.where(F.col("_next").isNull() | (F.col("_next") > F.col(at)) | F.col(at).isNull())
    # What a kept row is compared with is the kept row before it, so the comparison is made anew.
    kept = seen.withColumn("_before", F.lag(values).over(order)).withColumn("_n", F.row_number().over(order))
    changed = kept.where((F.col("_n") == 1) | ~F.col("_before").eqNullSafe(values))
    start = F.when(F.row_number().over(order) == 1, F.lit(FIRST).cast("timestamp")).otherwise(F.col(at).cast("timestamp"))
    end = F.coalesce(F.lead(at).over(order).cast("timestamp"), F.lit(OPEN).cast("timestamp"))
    out = changed.select(key, *tracked, start.alias("valid_from"), end.alias("valid_to"))
    return out.withColumn("is_current", F.col("valid_to") == F.lit(OPEN).cast("timestamp"))


def overlaps(history: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that reach into the next one of their key."""
    following = F.lead(start).over(Window.partitionBy(key).orderBy(start, end))
    return history.withColumn("_next", following).where(F.col("_next") < F.col(end)).drop("_next")


def effective_join(facts: DataFrame, history: DataFrame, key: tuple[str, str], at: str, start: str, end: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    """Each fact with the version valid at its time, start <= at < end; columns: output name -> history column.

    An equi-join on the key with the range as residual condition, so it is spread over the keys. With
    overlapping versions a fact comes once for each: test with overlaps(), or pick one by latest_by().
    """
    h = history.select(F.col(key[1]).alias("_k"), F.col(start).alias("_from"), F.col(end).alias("_to"), *(F.col(c).alias(n) for n, c in columns.items()))
    on = (facts[key[0]] == h["_k"]) & (facts[at] >= h["_from"]) & (facts[at] < h["_to"])
    return facts.join(h, on, how).drop("_k", "_from", "_to")
