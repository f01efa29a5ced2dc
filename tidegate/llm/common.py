"""Shared pieces: reading tables, Arrow maps, byte-level numpy helpers and checkpoints.

Text columns move between the JVM and Python as Arrow buffers and are worked on as
flat UTF-8 byte arrays, one block of rows at a time, so that the cost per byte is a few
numpy passes and the memory of a worker is bounded by the block and by the longest row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

U64 = np.uint64
BLOCK_BYTES = 2 << 20
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow with batches bounded in rows and bytes, so long rows do not pile up in a worker."""
    conf = df.sparkSession.conf
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{name}", None) is None:  # what the caller has set stands
            conf.set(f"spark.sql.execution.arrow.{name}", str(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()  # workers live on between tasks

    return df.mapInArrow(run, schema)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Frames made in here lose their shuffle files when an action on them ends, not when the driver happens to collect its garbage.

    For frames with one action: another one on the same frame would have to make the files anew.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that spark.checkpoint.dir names; the shuffle files behind it go.

    Where it names none, a local session uses one in its warehouse, and on a cluster this is an error: no
    folder made up here would be seen by all executors.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(folder)
    with shuffles_freed(spark):
        return df.select("*").checkpoint()


#: Keys of rows to be dropped go to every task up to this many (some 24 bytes each); beyond, both sides are shuffled.
SENT_KEYS = 1_000_000


def sent_if_few(keys: DataFrame) -> DataFrame:
    """The keys, counted, and marked for broadcast only if there are at most SENT_KEYS. They should be cheap to read twice."""
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys


def one_of_each(docs: DataFrame, judged: DataFrame, hashed: F.Column) -> DataFrame:
    """docs without the rows that judged(doc_id, th, stays) drops, and of those that agree in id and hash only one; columns unchanged.

    judged has one row per row of docs and is cheap to read. Texts are shuffled only where there are more
    keys than SENT_KEYS, or for rows that repeat both an id and a text.
    """
    names = docs.columns
    each = checkpointed(judged.groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.max("stays").alias("_s"), F.count("*").alias("_n")).where("not _s or _n > 1"))
    keyed = docs.withColumn("_th", hashed)

    def on(keys: DataFrame) -> list:
        return [keyed["_th"] == keys["_t"], keyed["doc_id"].eqNullSafe(keys["_d"])]

    listed = sent_if_few(each.select("_d", "_t"))
    out = keyed.join(listed, on(listed), "left_anti").select(*names)
    twice = each.where("_s").select("_d", "_t")
    if twice.isEmpty():
        return out
    twice = sent_if_few(twice)
    return out.unionByName(keyed.join(twice, on(twice), "left_semi").dropDuplicates(["doc_id", "_th"]).select(*names))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offs[0] : offs[-1]], offs - offs[0]


def row_blocks(data: np.ndarray, offs: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about block_bytes: (first row, end row, bytes, offsets)."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + block_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                    a = np.full(size, base, U64)
                    a[0] = 1
                    setattr(self, name, np.cumprod(a))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * base**position; range_hash() reads them."""
    up, _ = POWERS.get(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal content wherever it stands."""
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and the Latin-1 letters of UTF-8 bytes; length is kept."""
    out = _LOWER[data]
    if len(data) > 1:
        tail = data[1:]
        cap = (data[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        out[1:][cap] += 32
    return out


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of letters, digits and non-ASCII bytes within rows: (starts, ends, row of each)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = _WORD[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    first, last = offs[:-1][offs[:-1] < offs[1:]], offs[1:][offs[:-1] < offs[1:]] - 1
    start[first] = word[first]
    stop[last] = word[last]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return s, e, np.searchsorted(offs, s, side="right") - 1


def xxh_id(*columns) -> F.Column:
    """A 64-bit content hash for telling rows of one id apart in joins."""
    return F.xxhash64(*columns)
