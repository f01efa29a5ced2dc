"""Small control files, listings and copies on whatever store the path names, through Hadoop's file systems."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True, order=True)
class Entry:
    """A file below a root: its key and when it was last changed, in milliseconds."""

    key: str
    mtime: int


class Store:
    """Files under one root, by key."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, key: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}" if key else self.root)

    def uri(self, key: str) -> str:
        return f"{self.root}/{key}"

    def list(self, prefix: str = "") -> list[Entry]:
        """All files below a prefix, sorted by key; nothing if it is absent."""
        start = self._path(prefix)
        if not self._fs.exists(start):
            return []
        base = self._fs.makeQualified(self._path("")).toString().rstrip("/") + "/"
        found, it = [], self._fs.listFiles(start, True)
        while it.hasNext():
            f = it.next()
            found.append(Entry(f.getPath().toString().removeprefix(base), f.getModificationTime()))
        return sorted(found)

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(key))

    def read(self, key: str) -> Any:
        """A JSON file's content, or None if it is absent."""
        if not self.exists(key):
            return None
        stream = self._fs.open(self._path(key))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def write(self, key: str, value: Any) -> None:
        """Write a JSON file aside and move it over the old one, so a reader sees one or the other."""
        aside = self._path(f"{key}.tmp")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(value, indent=1, sort_keys=True, default=str).encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._conf)
        overwrite = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = overwrite
        context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(self._path(key)), options)

    def delete(self, key: str) -> None:
        self._fs.delete(self._path(key), True)

    def copy_to(self, key: str, other: Store) -> None:
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._path(key), other._fs, other._path(key), False, True, self._conf)
