"""What two batches over the events leave behind, against SQL over the events."""

from __future__ import annotations

import pytest

from tests.oracle import connect, spark_rows, sql_rows
from tidegate.plans import layers
from tidegate.plans.replay import FOUND, RUNS, SQL, replayed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", FOUND)
def test_query_against_sql(spark, con, name):
    assert spark_rows(FOUND[name](spark, SF)) == sql_rows(con, SQL[name])


def test_half_hours_of_zero(spark, tmp_path):
    """Those that are to be spoilt as negative are rejected as such, though nothing negated is nothing."""
    con = connect(SF)
    con.execute(f"COPY (SELECT * REPLACE (IF(event_id % 89 = 0 OR event_id % 10 = 0, 0.0, value) AS value) FROM events) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con = connect(str(tmp_path))
    for name in ("batch_readings", "batch_rejects", "batch_facts", "batch_daily", "batch_reconciliation", "batch_report", "batch_rerun"):
        assert spark_rows(FOUND[name](spark, str(tmp_path))) == sql_rows(con, SQL[name]), name


def test_only_the_days_of_a_run_are_written(spark):
    """Directories of days that a run did not touch are the same in the snapshots before and after it."""
    lake, _ = replayed(spark, SF)
    for name, value in (("conformed/meter_reading", str), ("mart/fact_meter_reads", lambda d: d.replace("-", ""))):
        table = lake.table(name)
        dirs = lambda v: {d["value"]: d["dir"] for d in table.snapshot(v)["dirs"]}
        changes = []
        for version in range(2, table.snapshot()["version"] + 1):
            before, after = dirs(version - 1), dirs(version)
            changes.append({d for d in after if before.get(d) != after[d]})
            assert set(before) <= set(after)
        days = {value(str(d)) for d in lake.df("conformed/meter_reading").where("last_batch_run_id = '" + RUNS[1] + "'").selectExpr("cast(settlement_date as string) as d").distinct().toPandas()["d"]}
        touched = [c for c in changes if c]
        assert touched and touched[0] <= days and touched[0] < set(dirs(table.snapshot()["version"]))


def test_views_and_drop(spark):
    lake, _ = replayed(spark, SF)
    names = layers.register_views(lake)
    assert {"mart_report_daily_consumption", "conformed_meter_reading", "control_rejects", "raw_meter"} <= set(names)
    table = lake.table("scratch/one")
    table.create(lake.df("mart/dim_date").schema)
    table.create(lake.df("mart/dim_tariff").schema)
    assert table.read().count() == 0 and table.schema() == lake.df("mart/dim_date").schema
    table.drop()
    assert not table.exists()
