"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = -1


def surrogate(*columns: str | Column) -> Column:
    """xxhash64 of the values as text, joined by a bar. Nulls are skipped, so keys of several columns need them non-null."""
    return F.xxhash64(F.concat_ws("|", *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns)))


def surrogate_or_unknown(when: Column, *columns: str | Column) -> Column:
    return F.when(when, surrogate(*columns)).otherwise(F.lit(UNKNOWN).cast("long"))


def date_key(column: str | Column) -> Column:
    """A date as the number yyyymmdd."""
    c = F.col(column) if isinstance(column, str) else column
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
