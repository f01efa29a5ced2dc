"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from tests.oracle import connect, spark_rows, sql_rows
from tidegate.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_against_sql(spark, name):
    assert spark_rows(queries()[name](spark, SF)) == sql_rows(connect(SF), oracle_sql()[name])


def test_names():
    assert [int(k[2:].split("_")[0]) for k in queries()] == list(range(1, 11))
