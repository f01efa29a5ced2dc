"""Command line: scenario, gate, batch, clear-hold and sql, on the lake that the environment names."""

from __future__ import annotations

import argparse
import json

from tidegate.plans import layers
from tidegate.session import session
from tidegate.settings import lake_from
from tidegate.sources.landing import clear_hold, run_gate
from tidegate.sources.scenario import Scenario


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidegate", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    scenario = steps.add_parser("scenario", help="land the files of one or both days of the metering scenario, or print what they have to leave behind")
    scenario.add_argument("--day", type=int, choices=(1, 2), action="append")
    scenario.add_argument("--customers", type=int, default=300)
    scenario.add_argument("--variant", default="baseline", choices=("baseline", "additive", "breaking_unit", "bad_control"))
    scenario.add_argument("--expected", action="store_true")
    for name, text in (("gate", "judge what has landed and write the run's manifest"), ("batch", "load, conform, build, check, reconcile and publish a run")):
        steps.add_parser(name, help=text).add_argument("run_id")
    steps.add_parser("clear-hold", help="let a held table's files through again").add_argument("table")
    steps.add_parser("sql", help="a query over the tables as views named layer_table").add_argument("query")
    found = parser.parse_args(args)
    lake = lake_from(session())
    out: object = None
    if found.step == "scenario":
        made = Scenario(lake.spark, found.customers, found.variant)
        out = made.expected() if found.expected else {f"day {d}": made.land(lake.landing, d) for d in found.day or (1, 2)}
    elif found.step == "gate":
        out = run_gate(lake.landing, lake.quarantine, lake.control, found.run_id)
    elif found.step == "batch":
        out = layers.run_batch(lake, found.run_id)
    elif found.step == "clear-hold":
        clear_hold(lake.control, found.table)
    else:
        layers.register_views(lake)
        lake.spark.sql(found.query).show(1000, truncate=False)
    if out is not None:
        print(json.dumps(out, indent=1, default=str))


if __name__ == "__main__":
    main()
