"""Merging a change set into a target, without a row-level table format."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Guard = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


class DuplicateSourceRows(ValueError):
    """A merge source has several rows for one key."""


def require_unique(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The source itself, after checking that no non-null key comes twice."""
    whole = source.dropna(subset=list(key))
    if (twice := whole.groupBy(*key).count().where("count > 1").first()) is not None:
        raise DuplicateSourceRows(f"{twice}")
    return source


def merge_rows(target: DataFrame, source: DataFrame, key: Sequence[str], guard: Guard | None = None) -> DataFrame:
    """Upsert as one full outer join on the key: matched rows come from the source where the guard holds, else from
    the target; unmatched rows of both sides stay. A null key matches nothing. A guard that is null does not hold.

    guard(s, t) gets accessors to the source's and the target's columns. The source has the target's columns and
    one row per key (see require_unique).
    """
    names = target.columns
    # A constant that is null only on the missing side; a struct of nulls alone would not tell.
    t = target.select(*(F.col(c).alias(f"t_{c}") for c in names), F.lit(True).alias("_t"))
    s = source.select(*(F.col(c).alias(f"s_{c}") for c in names), F.lit(True).alias("_s"))
    on = None
    for k in key:
        on = (t[f"t_{k}"] == s[f"s_{k}"]) if on is None else on & (t[f"t_{k}"] == s[f"s_{k}"])
    held = F.lit(True) if guard is None else F.coalesce(guard(lambda c: F.col(f"s_{c}"), lambda c: F.col(f"t_{c}")), F.lit(False))
    wins = F.col("_t").isNull() | (F.col("_s").isNotNull() & held)
    return t.join(s, on, "full_outer").select(*(F.when(wins, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in names))


def overlay(target: DataFrame, source: DataFrame, key: str, newer: tuple[str, str], values: dict[str, str], flag: str) -> DataFrame:
    """Update-only merge: where the source's row for the key is strictly newer (source column, target column), the named
    target columns take the source's values and the flag is true. The source has one row per key."""
    s = source.select(F.col(key).alias("_k"), F.col(newer[0]).alias("_new"), *(F.col(v).alias(f"_v_{c}") for c, v in values.items()))
    wins = F.coalesce(F.col("_new") > F.col(newer[1]), F.lit(False))
    joined = target.join(s, target[key] == s["_k"], "left")
    kept = [F.when(wins, F.col(f"_v_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns if c != flag]
    return joined.select(*kept, wins.alias(flag))
