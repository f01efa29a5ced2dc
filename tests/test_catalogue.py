from __future__ import annotations

import pytest

from tests.oracle import connect, spark_rows, sql_rows
from tidegate.plans.catalogue import FOUND, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert FOUND.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(FOUND))
def test_query_against_sql(spark, con, name):
    assert spark_rows(FOUND[name](spark, SF)) == sql_rows(con, SQL[name])
