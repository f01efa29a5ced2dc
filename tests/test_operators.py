"""Cases that the shared tables don't have: nulls, ties, deletes, restored files, crashes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegate.operators import checks, history, merge, rows, star
from tidegate.operators.control import reconcile, uncontrolled
from tidegate.schema import SOURCES, Verdict, compare
from tidegate.sources.files import Store
from tidegate.sources.landing import clear_hold, run_gate
from tidegate.sources.tables import SchemaMismatch, Table


def test_contract_comparison():
    base = {"a": "int", "b": "string"}
    assert compare(base, base).verdict is Verdict.SAME
    assert compare(base, base | {"c": "date"}).verdict is Verdict.ADDITIVE
    assert compare(base, {"a": "int", "c": "date"}).verdict is Verdict.BREAKING
    assert compare(base, {"a": "string", "b": "string"}).changed == ("a",)
    assert all({"Op", "dms_commit_ts"} <= c.landed.keys() for c in SOURCES.values()) and len(SOURCES) == 10


def test_merge_guards_null_keys_and_duplicates(spark):
    t = spark.createDataFrame([(1, 1, "old"), (2, 5, "old"), (None, 1, "t"), (4, None, "old")], "id int, v int, x string")
    s = spark.createDataFrame([(1, 1, "new"), (2, 4, "new"), (3, 1, "new"), (None, 1, "s"), (4, 1, "new")], "id int, v int, x string")
    got = sorted(map(tuple, merge.merge_rows(t, s, ["id"], lambda s, t: s("v") >= t("v")).collect()), key=repr)
    assert got == sorted([(1, 1, "new"), (2, 5, "old"), (3, 1, "new"), (4, None, "old"), (None, 1, "t"), (None, 1, "s")], key=repr)
    with pytest.raises(merge.DuplicateSourceRows):
        merge.require_unique(s.union(s), ["id"])


def test_history_sees_null_swaps_and_drops_empty_versions(spark):
    df = spark.createDataFrame([("k", "A", None, 1), ("k", None, "A", 2), ("k", None, "A", 3), ("k", "B", "B", 4), ("k", "C", "C", 4)], "id string, x string, y string, n int")
    df = df.withColumn("at", F.timestamp_seconds("n"))
    got = history.scd2(df, "id", ["x", "y"], "at", F.asc("x")).orderBy("valid_from").collect()
    assert [(r["x"], r["y"], r["is_current"]) for r in got] == [("A", None, False), (None, "A", False), ("C", "C", True)]
    assert history.overlaps(spark.createDataFrame(got), "id").count() == 0


def test_deletes_and_unknown_operations(spark):
    df = spark.createDataFrame([(1, "INSERT", 1), (1, "DELETE", 2), (2, "DELETE", 1), (2, "INSERT", 2), (3, None, 1)], "id int, op string, n int")
    assert sorted(r["id"] for r in rows.current_state(df, ["id"], "op", F.desc("n")).collect()) == [2, 3]


def test_every_status(spark):
    c = spark.createDataFrame([(1, 10.0, 1), (2, 10.0, 1), (3, None, 1), (4, 10.0, 2), (5, 10.0, 1), (6, 0.0, 1)], "k int, expected_total double, expected_count int")
    t = spark.createDataFrame([(1, 10.0, 1), (3, 1.0, 1), (4, 10.0, 1), (5, 11.0, 1), (6, 0.5, 1), (7, 1.0, 1)], "k int, target_total double, target_count int")
    got = {r["k"]: (r["status"], r["variance_pct"]) for r in reconcile(c, t, ["k"]).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "PASSED", 2: "MISSING_TARGET", 3: "MISSING_CONTROL", 4: "BLOCKED_COUNT", 5: "BLOCKED_TOTAL", 6: "BLOCKED_TOTAL"}
    assert got[6][1] == 100.0 and [r["k"] for r in uncontrolled(t, c, ["k"]).collect()] == [7]


def test_checks_on_an_empty_table_and_unknown_member(spark):
    empty = spark.createDataFrame([], "a int, b string")
    got = {r["check_name"]: r["value"] for r in checks.evaluate(empty, [checks.Check("d", checks.duplicates("a")), checks.Check("s", checks.share_where(F.col("a") > 0))]).collect()}
    assert got == {"d": 0.0, "s": 0.0}
    assert [tuple(r) for r in star.with_unknown_member(empty, "a").collect()] == [(-1, "UNKNOWN")]


def test_table_snapshots(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "p")
    t.append(spark.createDataFrame([("a", 1), ("b", 2)], "p string, n int"))
    t.overwrite_partitions(spark.createDataFrame([("b", 3)], "p string, n int"))
    assert sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 3)]
    assert sorted(map(tuple, t.read(version=1).collect())) == [("a", 1), ("b", 2)]
    t.append(spark.createDataFrame([("c", 4, "x")], "p string, n int, more string"))
    assert sorted((r["p"], r["more"]) for r in t.read().collect()) == [("a", None), ("b", None), ("c", "x")]
    with pytest.raises(SchemaMismatch):
        t.append(spark.createDataFrame([("c", "4")], "p string, n string"))
    t.overwrite_partitions(t.read().limit(0), ["a"])
    assert t.values() == ["b", "c"] and t.read(["c"]).count() == 1
    before = t.snapshot()
    t._write(t.read())  # a writer that dies before it moves the pointer
    assert t.snapshot() == before and t.read().count() == 2 and t.vacuum() >= 1 and t.read().count() == 2


def test_gate_protocol(spark, tmp_path):
    stores = [Store(spark, str(tmp_path / d)) for d in ("landing", "quarantine", "control")]
    landing, quarantine, control = stores
    good = SOURCES["meter"].landed
    bad = {k: v for k, v in good.items() if k != "status"}
    schemas = {"meter/1.parquet": good, "meter/2.parquet": bad, "meter/3.parquet": good, "tariff/1.parquet": SOURCES["tariff"].landed | {"extra": "int"}}

    def land(key):
        landing.write(key, "x")

    def gate(run):
        return run_gate(*stores, run, lambda store, key: schemas[key])

    for key in ("meter/1.parquet", "meter/2.parquet", "tariff/1.parquet", "other/1.parquet"):
        land(key)
    m = gate("r1")
    assert m["passed"] == {"meter": ["meter/1.parquet"], "tariff": ["tariff/1.parquet"]} and [q["reason"] for q in m["quarantined"]] == ["BREAKING_SCHEMA"]
    assert m["additive"][0]["added"] == ["extra"] and gate("r1") == m
    assert quarantine.exists("meter/2.parquet") and not landing.exists("meter/2.parquet")
    land("meter/3.parquet")
    assert [q["reason"] for q in gate("r2")["quarantined"]] == ["TABLE_HELD"]
    clear_hold(control, "meter")
    schemas["meter/2.parquet"] = good
    land("meter/2.parquet")  # restored under its old key
    land("meter/3.parquet")
    assert gate("r3")["passed"] == {"meter": ["meter/2.parquet", "meter/3.parquet"]}
    assert gate("r4")["passed"] == {}
