"""Tables of parquet files with snapshots: append, replace, partition overwrite and merge.

A table is a folder of immutable data directories and a pointer file that names the snapshot in force:
its schema and its directories, each with its partition value. A writer adds directories and
then moves the pointer, so a crash in between changes nothing, a table may be read while it is
rewritten, and older snapshots stay readable. One writer at a time, as in the system this serves.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.merge import Guard, merge_rows, require_unique
from tidegate.operators.rows import align
from tidegate.schema import family
from tidegate.sources.files import Store

POINTER = "_snapshots/current.json"


class SchemaMismatch(ValueError):
    """A column comes with another family than the table has."""


class Table:
    def __init__(self, spark: SparkSession, root: str, partition: str | None = None) -> None:
        self.spark, self.store, self.partition = spark, Store(spark, root), partition

    def snapshot(self, version: int | None = None) -> dict | None:
        return self.store.read(POINTER if version is None else f"_snapshots/{version}.json")

    def exists(self) -> bool:
        return self.snapshot() is not None

    def schema(self) -> T.StructType | None:
        now = self.snapshot()
        return T.StructType.fromJson(now["schema"]) if now else None

    def read(self, values: Sequence | None = None, version: int | None = None) -> DataFrame:
        """The table, or only the partitions of the given values, whose directories alone are listed and read."""
        now = self.snapshot(version)
        if now is None:
            raise FileNotFoundError(self.store.root)
        schema = T.StructType.fromJson(now["schema"])
        wanted = None if values is None else {str(v) for v in values}
        dirs = [d["dir"] for d in now["dirs"] if wanted is None or d["value"] in wanted]
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self.store.uri(d) for d in dirs))

    def values(self) -> list[str]:
        """Partition values in force, in order."""
        now = self.snapshot()
        return sorted({d["value"] for d in now["dirs"]}) if now else []

    def _write(self, df: DataFrame) -> list[dict]:
        """New directories, one per partition value; the value is also kept as a column of the data."""
        name = f"data/{uuid.uuid4().hex}"
        if self.partition is None:
            df.write.parquet(self.store.uri(name))
            return [{"dir": name, "value": ""}]
        df.withColumn("_part", F.col(self.partition).cast("string")).write.partitionBy("_part").parquet(self.store.uri(name))
        found = {e.key.split("/")[2] for e in self.store.list(name) if e.key.count("/") > 2}
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return [{"dir": f"{name}/{d}", "value": unescape(d.removeprefix("_part="))} for d in sorted(found)]

    def _commit(self, schema: T.StructType, dirs: list[dict]) -> None:
        now = self.snapshot()
        version = now["version"] + 1 if now else 1
        after = {"version": version, "schema": schema.jsonValue(), "dirs": dirs}
        self.store.write(f"_snapshots/{version}.json", after)
        self.store.write(POINTER, after)

    def _evolved(self, df: DataFrame) -> tuple[T.StructType, DataFrame]:
        """The schema with the columns that df adds, and df brought to it."""
        have = self.schema()
        if have is None:
            return df.schema, df
        known = {f.name: f for f in have}
        if wrong := [f.name for f in df.schema if f.name in known and family(f.dataType) != family(known[f.name].dataType)]:
            raise SchemaMismatch(f"{self.store.root}: {wrong}")
        schema = T.StructType([*have, *(T.StructField(f.name, f.dataType, True) for f in df.schema if f.name not in known)])
        return schema, align(df, schema)

    def replace(self, df: DataFrame) -> None:
        """Put df in place of all rows. df may read this table."""
        self._commit(df.schema, self._write(df))

    def append(self, df: DataFrame) -> None:
        """Add rows; columns the table lacks are added to it, those that df lacks are null."""
        schema, rows = self._evolved(df)
        now = self.snapshot()
        self._commit(schema, [*(now["dirs"] if now else []), *self._write(rows)])

    def overwrite_partitions(self, df: DataFrame, values: Sequence | None = None) -> None:
        """Replace the partitions that occur in df, and those of `values` even where df has no row for them."""
        schema, rows = self._evolved(df)
        new = self._write(rows)
        gone = {d["value"] for d in new} | {str(v) for v in values or ()}
        now = self.snapshot()
        self._commit(schema, [*(d for d in (now["dirs"] if now else []) if d["value"] not in gone), *new])

    def holding(self, keys: DataFrame, key: Sequence[str]) -> list[str]:
        """Values of the partitions that have rows of the given keys. Reads the key and partition columns only; as many values as partitions at most."""
        rows = self.read().select(*key, F.col(self.partition).cast("string").alias("_part"))
        return sorted(r["_part"] for r in rows.join(keys.select(*key).dropna().distinct(), list(key), "left_semi").select("_part").distinct().collect() if r["_part"] is not None)

    def merge(self, source: DataFrame, key: Sequence[str], guard: Guard | None = None, touched: Sequence | None = None) -> list[str]:
        """Upsert by key; see merge_rows(). A key that comes twice in the source is an error.

        Of a partitioned table only the partitions that the source's rows stand in, now or before, are read and written;
        the source's partition values must not be null. touched, if given, are the values that hold the source's keys now.
        The values written, or [] for a table without partitions.
        """
        require_unique(source, key)
        now = self.schema()
        if self.partition is None:
            self.replace(source if now is None else merge_rows(self.read(), align(source, now), key, guard))
            return []
        if now is None:
            self.append(source)
            return self.values()
        held = self.holding(source, key) if touched is None else [str(v) for v in touched]
        new = [str(r[0]) for r in source.select(F.col(self.partition).cast("string")).distinct().collect()]  # as many as partitions
        values = sorted({*held, *new})
        self.overwrite_partitions(merge_rows(self.read(values), align(source, now), key, guard), values)
        return values

    def delete_keys(self, keys: DataFrame, key: Sequence[str]) -> None:
        """Remove the rows of the given keys, rewriting the partitions that hold them; null keys match nothing."""
        values = None if self.partition is None else self.holding(keys, key)
        left = self.read(values).join(keys.select(*key).dropna().distinct(), list(key), "left_anti").select(*self.schema().names)
        if values is None:
            self.replace(left)
        elif values:
            self.overwrite_partitions(left, values)

    def create(self, schema: T.StructType) -> None:
        """An empty table of the given schema, unless there is one already."""
        if not self.exists():
            self._commit(schema, [])

    def drop(self) -> None:
        """Remove the table with all its snapshots and data."""
        self.store.delete("")

    def vacuum(self) -> int:
        """Delete data directories that the snapshot in force doesn't name; older snapshots can't be read any more."""
        now = self.snapshot() or {"dirs": []}
        live = {d["dir"].split("/")[1] for d in now["dirs"]}
        dead = {e.key.split("/")[1] for e in self.store.list("data")} - live
        for d in dead:
            self.store.delete(f"data/{d}")
        return len(dead)
