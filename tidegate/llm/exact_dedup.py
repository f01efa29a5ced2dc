"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks; each chunk has a polynomial hash under four (prime, base) pairs, and
the hash of a concatenation is H(a) + base**len(a) * H(b), so chunks of a huge document can be
hashed apart, anywhere, and combined in order. Equal fingerprints are only candidates: the texts
behind them are compared chunk by chunk, as a stream of (fingerprint, chunk number, bytes) rows
that is reduced on the map side, so a group of any size costs one row per task and chunk. Texts whose
fingerprint occurs once have nothing to be compared with and leave the stream before it is shuffled.
A fingerprint whose chunks differ anywhere is split by SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import arrow_map, checkpointed, column_bytes, one_of_each, row_blocks, sent_if_few

#: Primes below 2**31 and bases.
FIELDS = ((2147483647, 48271), (2147483629, 69621), (2147483587, 1103515245), (2147483579, 742938285))
CHUNK = 1 << 14

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers() -> list[np.ndarray]:
    out = []
    for prime, base in FIELDS:
        pw = np.ones(CHUNK, np.int64)
        for step in (1 << k for k in range(CHUNK.bit_length() - 1)):
            pw[step : 2 * step] = pw[:step] * pow(base, step, prime) % prime
        out.append(pw)
    return out


_POWERS = _powers()


def squeeze(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace each run of white space within a row by one space."""
    space = _SPACE[data]
    drop = np.zeros(len(data), bool)
    if len(data):
        drop[1:] = space[1:] & space[:-1]
        first = offs[:-1][offs[:-1] < offs[1:]]
        drop[first] = False
    keep = ~drop
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(space, np.uint8(32), data)[keep], kept[offs]


def chunk_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for back-to-back chunks of at most CHUNK bytes: (fields, chunks)."""
    out = np.zeros((len(FIELDS), len(starts)), np.int64)
    full = ends > starts
    if not full.any():
        return out
    s, e = starts[full], ends[full]
    at = np.arange(s[0], e[-1]) - np.repeat(s, e - s)
    values = data[s[0] : e[-1]].astype(np.int64) + 1
    for k, (prime, _) in enumerate(FIELDS):
        out[k, full] = np.add.reduceat(values * _POWERS[k][at], s - s[0]) % prime
    return out


def combine(left: tuple[int, ...], left_length: int, right: tuple[int, ...]) -> tuple[int, ...]:
    """The hash of a concatenation from the hashes of its parts and the length of the first."""
    return tuple((a + pow(base, left_length, prime) * b) % prime for a, b, (prime, base) in zip(left, right, FIELDS, strict=True))


def fingerprints(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Fingerprints of all rows of a block: (rows, 4)."""
    length = offs[1:] - offs[:-1]
    parts = np.maximum(1, -(-length // CHUNK))
    row = np.repeat(np.arange(len(length)), parts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = offs[:-1][row] + number * CHUNK
    ends = np.minimum(starts + CHUNK, offs[1:][row])
    hashed = chunk_hashes(data, starts, ends)
    first = np.cumsum(parts) - parts
    out = hashed[:, first].T.copy()
    for r in np.flatnonzero(parts > 1):
        total = tuple(int(x) for x in out[r])
        for c in range(1, parts[r]):
            total = combine(total, c * CHUNK, tuple(int(x) for x in hashed[:, first[r] + c]))
        out[r] = total
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        for lo, hi, part, at in row_blocks(data, offs):
            text, cut = squeeze(part, at)
            raw = text.tobytes()
            fp = fingerprints(text, cut)
            sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(fp[:, 0] << 31 | fp[:, 1]), pa.array(fp[:, 2] << 31 | fp[:, 3]), pa.array(cut[1:] - cut[:-1]), pa.array(sha)],
                names=["doc_id", "fp_a", "fp_b", "n_bytes", "text_sha256"],
            )


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        for _, _, part, at in row_blocks(data, offs):
            text, cut = squeeze(part, at)
            fp, length = fingerprints(text, cut), cut[1:] - cut[:-1]
            parts = -(-length // CHUNK)
            row = np.repeat(np.arange(len(length)), parts)
            number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            edges = np.append(cut[:-1][row] + number * CHUNK, cut[-1]).astype(np.int32)
            pieces = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(text.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array((fp[:, 0] << 31 | fp[:, 1])[row]), pa.array((fp[:, 2] << 31 | fp[:, 3])[row]), pa.array(length[row]), pa.array(number), pieces],
                names=["fp_a", "fp_b", "n_bytes", "chunk", "bytes"],
            )


def exact_groups(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, keep_id, group_size, kept, text_sha256; one row per input row.

    Null texts count as empty. Texts are equal when identical after each run of space, tab, LF, VT,
    FF and CR becomes one space. keep_id is the smallest doc_id of the group (null only if all its
    ids are null). If several rows share that smallest id, kept is true on each of them; use
    exact_dedup() to keep one. Other columns of docs are not looked at.
    """
    fp = ["fp_a", "fp_b", "n_bytes"]
    source = docs.select("doc_id", "text")
    rows = checkpointed(arrow_map(source, _fingerprint_batches, "doc_id long, fp_a long, fp_b long, n_bytes long, text_sha256 string"))
    repeated = checkpointed(rows.groupBy(*fp).agg(F.count("*").alias("n")).where("n > 1").select(*fp))
    chunks = arrow_map(source, _chunk_batches, "fp_a long, fp_b long, n_bytes long, chunk long, bytes binary")
    chunks = chunks.join(sent_if_few(repeated), fp, "left_semi")
    # Streaming comparison: a chunk that has one content among all rows of a fingerprint is equal everywhere.
    contents = chunks.groupBy(*fp, "chunk", "bytes").agg(F.lit(1).alias("one"))
    differing = contents.groupBy(*fp, "chunk").agg(F.count("*").alias("n")).where("n > 1").select(*fp).distinct().withColumn("split", F.lit(True))
    groups = rows.groupBy(*fp, "text_sha256").agg(F.min("doc_id").alias("keep_sha"), F.count("*").alias("n_sha"))
    groups = groups.join(differing, fp, "left")
    whole = groups.groupBy(*fp).agg(F.min("keep_sha").alias("keep_all"), F.sum("n_sha").alias("n_all"))
    groups = groups.join(whole, fp).select(
        *fp,
        "text_sha256",
        F.when(F.col("split"), F.col("keep_sha")).otherwise(F.col("keep_all")).alias("keep_id"),
        F.when(F.col("split"), F.col("n_sha")).otherwise(F.col("n_all")).alias("group_size"),
    )
    return rows.join(groups, [*fp, "text_sha256"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """docs with only the row of smallest doc_id of each group of equal texts, all columns unchanged.

    Where rows repeat an id, one of those with equal text stays; the first of several ids is the smallest,
    and a null id is larger than any other. Null texts count as empty. An empty table gives no rows.
    """
    judged = exact_groups(docs).select("doc_id", F.col("text_sha256").alias("th"), F.col("kept").alias("stays"))
    normal = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return one_of_each(docs, judged, F.sha2(normal.cast("binary"), 256))
