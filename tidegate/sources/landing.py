"""The gate before the raw layer: which landed files may be loaded.

Every run writes one manifest, and asking again for the run gives it back. Files are judged by the
families of their columns, from the parquet footer. A breaking file is moved to quarantine and
its table is held: later files of the table wait too, until the hold is cleared. The manifest is
written before the state, so a crash between the two makes the next run look at the files again.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from tidegate.schema import SOURCES, Verdict, compare, families
from tidegate.sources.files import Store

#: Files that get their time stamp before they appear are seen by looking back this far.
OVERLAP_MS = 10 * 60 * 1000
FOOTERS_AT_ONCE = 16
STATE = "gate/state.json"


def _footer(store: Store, key: str) -> dict[str, str]:
    return families(store.spark.read.parquet(store.uri(key)).schema)


def holds(control: Store) -> set[str]:
    return {e.key.split("/")[-1].removesuffix(".json") for e in control.list("gate/holds") if e.key.endswith(".json")}


def clear_hold(control: Store, table: str) -> None:
    control.delete(f"gate/holds/{table}.json")


def run_gate(landing: Store, quarantine: Store, control: Store, run_id: str, schema_of: Callable[[Store, str], dict[str, str]] = _footer, tables: Collection[str] = tuple(SOURCES)) -> dict:
    """The run's manifest: passed {table: [keys]}, quarantined and additive [{key, table, ...}], has_quarantine.

    A file that was quarantined and comes back under its key is judged again: what has been checked is
    remembered as key and time of change, not as key alone.
    """
    manifest_key = f"gate/manifests/{run_id}.json"
    if (known := control.read(manifest_key)) is not None:
        return known
    state = control.read(STATE) or {"watermark": 0, "checked": {}}
    checked: dict[str, int] = state["checked"]
    seen = [e for e in landing.list() if e.key.endswith(".parquet") and e.mtime >= state["watermark"] - OVERLAP_MS]
    todo = sorted((e for e in seen if checked.get(e.key) != e.mtime), key=lambda e: (e.mtime, e.key))
    held = holds(control)
    known_tables = [e for e in todo if e.key.split("/")[0] in tables and e.key.split("/")[0] not in held]
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = dict(zip([e.key for e in known_tables], pool.map(lambda e: schema_of(landing, e.key), known_tables), strict=True))
    passed: dict[str, list[str]] = {}
    quarantined, additive = [], []
    for e in todo:
        table = e.key.split("/")[0]
        if table not in tables:
            continue
        reason, found = None, None
        if table in held:
            reason = "TABLE_HELD"
        else:
            found = compare(SOURCES[table].landed, schemas[e.key])
            if found.verdict is Verdict.BREAKING:
                reason = "BREAKING_SCHEMA"
                held.add(table)
                control.write(f"gate/holds/{table}.json", {"run_id": run_id, "key": e.key, "dropped": found.dropped, "changed": found.changed})
            elif found.verdict is Verdict.ADDITIVE:
                additive.append({"key": e.key, "table": table, "added": list(found.added)})
        if reason:
            quarantined.append({"key": e.key, "table": table, "reason": reason})
            landing.copy_to(e.key, quarantine)
            landing.delete(e.key)
        else:
            passed.setdefault(table, []).append(e.key)
    manifest = {"run_id": run_id, "created_at": datetime.datetime.now(datetime.UTC).isoformat(), "passed": passed, "quarantined": quarantined, "additive": additive, "has_quarantine": bool(quarantined)}
    control.write(manifest_key, manifest)
    watermark = max([state["watermark"], *(e.mtime for e in seen)])
    gone = {q["key"] for q in quarantined}
    recent = {e.key: e.mtime for e in seen if e.mtime >= watermark - OVERLAP_MS and e.key not in gone}
    control.write(STATE, {"watermark": watermark, "checked": {k: m for k, m in checked.items() if k not in gone and m >= watermark - OVERLAP_MS} | recent})
    return manifest
