"""Two days of change capture through gate, layers, checks, reconciliation and report."""

from __future__ import annotations

import shutil
import time

import pytest
from pyspark.sql import functions as F

from tidegate.plans import layers
from tidegate.plans.layers import Lake
from tidegate.sources.landing import clear_hold, holds, run_gate
from tidegate.sources.scenario import Scenario


def start(spark, root, customers=60):
    lake = Lake(spark, str(root))
    scenario = Scenario(spark, customers)
    scenario.land(lake.landing, 1)
    run_gate(lake.landing, lake.quarantine, lake.control, "day1")
    return lake, scenario, layers.run_batch(lake, "day1")


@pytest.fixture(scope="module")
def after_day1(spark, tmp_path_factory):
    """A small lake after its first day, to be copied by tests that go on differently."""
    root = tmp_path_factory.mktemp("small")
    start(spark, root, 10)
    return root


def day2(spark, after_day1, tmp_path, variant):
    shutil.copytree(after_day1, tmp_path / "lake")
    lake = Lake(spark, str(tmp_path / "lake"))
    return lake, second(lake, Scenario(spark, 10, variant))


def second(lake, scenario):
    time.sleep(1.1)
    scenario.land(lake.landing, 2)
    return run_gate(lake.landing, lake.quarantine, lake.control, "day2")


@pytest.fixture(scope="module")
def baseline(spark, tmp_path_factory):
    lake, scenario, first = start(spark, tmp_path_factory.mktemp("lake"))
    manifest = second(lake, scenario)
    return lake, scenario, first, manifest, layers.run_batch(lake, "day2")


def counts(lake):
    return {t: lake.df(t).count() for t in ("raw/meter_reading", "conformed/meter_reading", "conformed/customer_history", "control/rejects", "mart/fact_meter_reads", "mart/fact_consumption_daily", "mart/report_daily_consumption")}


def test_expected_numbers(baseline):
    lake, scenario, first, manifest, last = baseline
    assert first["conformed"]["readings"] == {"rows_in": 3482, "rows_rejected": 52}
    assert last["conformed"]["readings"] == {"rows_in": 3678, "rows_rejected": 56}
    assert not manifest["has_quarantine"]
    found = counts(lake)
    assert found["raw/meter_reading"] == 3482 + 3678
    assert found["conformed/meter_reading"] == found["mart/fact_meter_reads"] == 3417 + 3608
    assert found["conformed/customer_history"] == 61
    assert found["control/rejects"] == 108
    assert last["published_dates"] == 2


def test_totals_are_exact_and_days_complete(baseline):
    lake, scenario, *_ = baseline
    built = {r["date_key"]: r for r in lake.df("mart/fact_consumption_daily").groupBy("date_key").agg(F.sum("daily_kwh").alias("t"), F.max("expected_intervals").alias("i"), F.sum("valid_intervals").alias("n")).collect()}
    for day, key, slots in ((1, 20261024, 48), (2, 20261025, 50)):
        want = scenario.totals(day, corrected=day == 1).first()
        assert (built[key]["t"], built[key]["n"], built[key]["i"]) == (want["expected_total"], want["expected_count"], slots)
    fixed = lake.df("conformed/meter_reading").where("correction_applied").count()
    assert fixed == scenario.corrections().count() > 0


def test_reasons_and_statuses(baseline):
    lake, *_ , last = baseline
    assert {r["status"] for r in last["reconciliation"]} == {"PASSED"}
    reasons = {r["rejection_reason"]: r["count"] for r in lake.df("control/rejects").groupBy("rejection_reason").count().collect()}
    assert reasons == {"NULL_CONSUMPTION": 27, "NEGATIVE_CONSUMPTION": 27, "INVALID_READING_TYPE": 27, "UNKNOWN_METER": 27}
    assert layers.uncontrolled_dates(lake) == []
    current = lake.df("conformed/customer_history").where("is_current").groupBy("customer_id").count()
    assert current.where("count = 1").count() == 60


def test_changed_tariff_counts_from_its_day(baseline):
    lake, *_ = baseline
    sold = lake.df("mart/fact_consumption_daily").join(lake.df("mart/dim_meter").select("meter_sk", "meter_id"), "meter_sk").join(lake.df("mart/dim_tariff").select("tariff_sk", "tariff_id"), "tariff_sk")
    assert {(r["date_key"], r["tariff_id"]) for r in sold.where("meter_id = 'M00002'").collect()} == {(20261024, "T2"), (20261025, "T3")}


def test_rerun_changes_nothing(baseline):
    lake, *_ = baseline
    before = counts(lake)
    layers.run_batch(lake, "day2")
    assert counts(lake) == before
    layers.run_batch(lake, "day1")
    assert counts(lake) == before


def test_bad_control_blocks_and_keeps_evidence(spark, after_day1, tmp_path):
    lake, _ = day2(spark, after_day1, tmp_path, "bad_control")
    with pytest.raises(layers.ReconciliationBlocked, match="BLOCKED_TOTAL"):
        layers.run_batch(lake, "day2")
    status = {(r["date_key"], r["status"]) for r in lake.table("mart/fact_reconciliation").read(["day2"]).collect()}
    assert status == {(20261024, "PASSED"), (20261025, "BLOCKED_TOTAL")}
    assert layers.publish(lake, "day2") == 1
    assert lake.table("mart/report_daily_consumption").values() == ["20261024"]


def test_breaking_change_is_held_and_target_missing(spark, after_day1, tmp_path):
    lake, manifest = day2(spark, after_day1, tmp_path, "breaking_unit")
    assert [q["reason"] for q in manifest["quarantined"]] == ["BREAKING_SCHEMA"] and holds(lake.control) == {"meter_reading"}
    with pytest.raises(layers.ReconciliationBlocked, match="MISSING_TARGET"):
        layers.run_batch(lake, "day2")
    clear_hold(lake.control, "meter_reading")
    assert holds(lake.control) == set()


def test_additive_column_reaches_raw_only(spark, after_day1, tmp_path):
    lake, manifest = day2(spark, after_day1, tmp_path, "additive")
    assert [(a["table"], a["added"]) for a in manifest["additive"]] == [("meter", ["firmware_version"])]
    layers.run_batch(lake, "day2")
    versions = {r["firmware_version"] for r in lake.df("raw/meter").collect()}
    assert versions == {None, "1.0"} and "firmware_version" not in lake.df("conformed/meter").columns
