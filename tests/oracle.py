"""Comparison of a query's rows with DuckDB's, whatever their order."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(sf_dir, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[k]) for k in order) for r in rows), key=repr)


def spark_rows(df) -> list[tuple]:
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> list[tuple]:
    found = con.execute(sql)
    return rows_of([d[0] for d in found.description], found.fetchall())
