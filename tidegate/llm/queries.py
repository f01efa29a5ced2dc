"""The queries of this subpackage: thin wrappers that apply each operator to its whole table.

Nulls in any column, empty and long texts, ties, repeated rows, empty tables and further columns of any name have
the results that the operators' docstrings state; the wrappers add nothing to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import html_text, quality, sql, toxicity
from tidegate.llm.common import read_table
from tidegate.llm.decontaminate import contaminated
from tidegate.llm.exact_dedup import exact_groups
from tidegate.llm.pieces import Vocabulary, encoded
from tidegate.llm.pseudonyms import pseudonymised
from tidegate.llm.sharding import interleaved_shards
from tidegate.llm.simhash import simhash_components
from tidegate.llm.suffix_dedup import remove_repeats


#: The session's setting that holds the secret key of op10; without it an example key is used.
PSEUDONYM_KEY = "tidegate.pseudonym.key"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op4_interleaved_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(read_table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(read_table(spark, sf_dir, "pages"), html_text.train())


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read_table(spark, sf_dir, "documents"), Vocabulary.load())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PSEUDONYM_KEY, None) or "an example key, to be replaced by a secret one"
    return pseudonymised(read_table(spark, sf_dir, "documents"), key.encode())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontamination, op2_suffix_dedup, op3_simhash_near_dedup, op4_interleaved_sharding, op5_main_text, op6_pieces, op7_exact_dedup, op8_quality, op9_toxicity, op10_pseudonyms)}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": sql.CONTAMINATED, "op2_suffix_dedup": sql.REPEATS, "op7_exact_dedup": sql.EXACT}
