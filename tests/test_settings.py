"""Settings from the environment, the command line, and the scenario's own account of what it expects."""

from __future__ import annotations

import pytest

from tidegate import __main__ as command
from tidegate.settings import lake_from
from tidegate.sources.scenario import Scenario


def test_lake_of_an_environment(spark):
    lake = lake_from(spark, {"LAKE_WAREHOUSE": "/w/", "LAKE_CATALOG": "c", "LAKE_ENV": "dev", "LAKE_CTL_URI": "/ctl", "LAKE_RECON_THRESHOLD_PCT": "0.5"})
    assert (lake.root, lake.landing.root, lake.control.root, lake.threshold_pct) == ("/w/c/dev", "/w/c/dev/landing", "/ctl", 0.5)
    assert lake_from(spark, {"LAKE_WAREHOUSE": "/w"}).threshold_pct == 0.01
    with pytest.raises(KeyError):
        lake_from(spark, {})


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("LAKE_WAREHOUSE", str(tmp_path))
    monkeypatch.setattr(command, "session", lambda: spark)
    command.main(["scenario", "--day", "1", "--customers", "5"])
    command.main(["gate", "r1"])
    command.main(["batch", "r1"])
    command.main(["sql", "SELECT count(*) AS readings FROM conformed_meter_reading"])
    said = capsys.readouterr().out
    assert '"has_quarantine": false' in said and '"published_dates": 1' in said and "|readings|" in said
    command.main(["clear-hold", "meter"])
    with pytest.raises(SystemExit):
        command.main(["nothing"])


def test_expected_record(spark):
    found = Scenario(spark, 60).expected()
    assert [(d["landed"], d["rejected"], d["valid"], d["periods"]) for d in found["days"]] == [(3482, 52, 3417, 48), (3678, 56, 3608, 50)]
    assert found["corrections"] > 0 and all(d["landed"] - d["rejected"] > d["valid"] for d in found["days"])
