"""Dimensions with an unknown member, and references that point nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.keys import UNKNOWN


def with_unknown_member(dim: DataFrame, key: str) -> DataFrame:
    """The dimension and one more row: key -1, text columns 'UNKNOWN', all others null."""
    row = dim.sparkSession.range(1).select(
        *((F.lit(UNKNOWN) if f.name == key else F.lit("UNKNOWN") if isinstance(f.dataType, T.StringType) else F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema)
    )
    return dim.unionByName(row)


def orphans(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Distinct non-null references of facts that the dimension lacks."""
    keys = facts.select(F.col(fact_key).alias("key")).where("key is not null").distinct()
    return keys.join(dim.select(F.col(dim_key).alias("key")), "key", "left_anti")
