"""Corpus pipeline over `documents`: score, dedup, near-dedup, decontaminate, encode.

Each stage takes all that the one before kept and hands on the columns of `documents`; the last one
returns the pieces. Stages only call operators: no limits, samples or id filters are set here.

In every stage null ids and nulls in other columns are carried along, a null text counts as an empty one, very long texts
are read whole, an empty table gives no rows, and further columns of any name go through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import quality
from tidegate.llm.decontaminate import drop_contaminated
from tidegate.llm.exact_dedup import exact_dedup
from tidegate.llm.near_dedup import near_dedup
from tidegate.llm.pieces import Vocabulary, encoded


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network scores under its threshold go; repeated rows have equal scores and go or stay together."""
    return quality.keep_quality(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, white space aside, the one of smallest id stays, and one row of it; a null id is the largest."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles are similar by 0.8 or more, over any number of links, the one of smallest id stays; texts without words are alike."""
    return near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go; repeated rows stay as often as they come."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the N best segmentations of what is left, one row per document; an empty text has no pieces."""
    return encoded(docs, Vocabulary.load())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pieces", to_pieces),
]

#: A trained network and lattice searches are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
