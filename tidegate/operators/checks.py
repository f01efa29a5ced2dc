"""Data-quality checks as aggregates: all checks of one table share one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """An aggregate that has to stay at or below a limit."""

    name: str
    value: Column
    limit: float = 0.0
    severity: str = "error"


def duplicates(*key: str) -> Column:
    """Rows beyond the first of each key."""
    return F.count("*") - F.count_distinct(F.struct(*key))


def count_where(test: Column) -> Column:
    return F.count(F.when(test, F.lit(1)))


def share_where(test: Column) -> Column:
    """Share of rows for which the test holds; 0 for an empty table."""
    return F.coalesce(F.try_divide(count_where(test).cast("double"), F.count("*").cast("double")), F.lit(0.0))


def evaluate(df: DataFrame, checks: list[Check]) -> DataFrame:
    """check_name, severity, value, passed: one row per check, one scan for all."""
    values = df.agg(*(c.value.cast("double").alias(f"c{k}") for k, c in enumerate(checks)))
    rows = F.array(*(F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"c{k}").alias("value"), (F.col(f"c{k}") <= c.limit).alias("passed")) for k, c in enumerate(checks)))
    return values.select(F.explode(rows).alias("r")).select("r.*")
