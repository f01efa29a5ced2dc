"""Row selection: newest per key, current state, reject reasons, alignment to a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_by(df: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, first in the given order. The order should end in a tie-break that makes it total.

    A rank limited to one, which Spark cuts down before and after the shuffle on the key.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def current_state(df: DataFrame, key: Sequence[str], operation: str, *order: Column, deleted: str = "DELETE") -> DataFrame:
    """The newest row per key, unless that is a delete. A row of unknown operation counts as a change, not as nothing."""
    return latest_by(df, key, *order).where(~F.col(operation).eqNullSafe(deleted))


def with_reason(df: DataFrame, rules: Sequence[tuple[str, Column]], column: str = "rejection_reason") -> DataFrame:
    """The first rule that holds names the reason; null means accepted. A rule that is null does not hold."""
    reason = F.lit(None).cast("string")
    for name, test in reversed(rules):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    return df.withColumn(column, reason)


def rejected(df: DataFrame, table: str, run: str, column: str = "rejection_reason") -> DataFrame:
    """Dead-letter rows: the rejected row as JSON, with its reason."""
    payload = F.to_json(F.struct(*(c for c in df.columns if c != column)))
    return df.where(F.col(column).isNotNull()).select(F.lit(table).alias("table_name"), F.lit(run).alias("batch_run_id"), column, payload.alias("payload"), F.current_timestamp().alias("rejected_at"))


def accepted(df: DataFrame, column: str = "rejection_reason") -> DataFrame:
    return df.where(F.col(column).isNull()).drop(column)


def known_keys(df: DataFrame, keys: DataFrame, column: str, flag: str) -> DataFrame:
    """Flag the rows whose key occurs among keys; others get false. Null keys are not known."""
    probe = keys.select(F.col(column).alias("_known")).where("_known is not null").distinct()
    return df.join(probe, df[column] == probe["_known"], "left").withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in its order: missing ones null, others cast. Columns the target lacks are left out."""
    have = set(df.columns)
    return df.select(*((F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in target))


def union_aligned(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, all columns: a column that one side lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def missing_from(df: DataFrame, other: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys of df that other does not have."""
    return df.select(*columns).distinct().join(other.select(*columns).distinct(), list(columns), "left_anti")
