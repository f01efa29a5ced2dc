"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is read as a ring of 8 segments. If two fingerprints differ in at most 3 bits,
then by the pigeonring principle some segment starts a chain of which every prefix of l segments
differs in at most l * 3 / 8 bits: none in the first two, one at most in the first five, two at most
in the first seven. So some start has two equal segments and two more equal among the next three;
these 32 bits are the join key (8 starts x 3 choices), the full chain of budgets prunes the pairs
that meet under a key, and what is left has its Hamming distance counted.

Only distinct fingerprints take part, and a key's fingerprints yield a spanning forest of their
links rather than all pairs. A key with very many fingerprints is split: three bits cannot touch all
four segments that a key leaves free, so its fingerprints meet again under each of these with its value,
and no task holds more than the 2**24 fingerprints that five equal segments allow.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import U64, arrow_map, checkpointed, column_bytes, sent_if_few
from tidegate.llm.components import connected_components

BITS, SEGMENTS, DISTANCE, SHINGLE = 64, 8, 3, 3
WIDTH = BITS // SEGMENTS
#: Of the five segments of a chain, the first two and two of the others are equal.
CHOICES = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4))
#: From this many fingerprints under a key on, candidates are looked up by their few possible differences, not found by going through all.
LOOKUP_FROM = 12_000
#: A key of this many fingerprints is split by a fifth equal segment.
SPLIT_FROM = 100_000
#: Equal segments of a key, and of one that is split.
EQUAL, EQUAL_SPLIT = 4, 5

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: bytes, width: int) -> list[bytes]:
    """The word shingles of a UTF-8 text, repeats included; the whole sequence if it has fewer words."""
    words = text.translate(_LOWER).split()  # bytes.split() splits at exactly space, tab, LF, VT, FF and CR
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """A bit is set where over half the shingles' XXH64 (seed 42) have it; 0 for a text without words."""
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, width)]
    if not hashed:
        return 0
    bits = np.unpackbits(np.array(hashed, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashed)).tobytes(), "big")


def _fingerprint_batches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            raw, cut = data.tobytes(), offs.tolist()
            out = np.array([fingerprint(raw[a:b], width) for a, b in zip(cut[:-1], cut[1:], strict=True)], U64)
            others = [k for k in batch.schema.names if k != "text"]
            yield pa.RecordBatch.from_arrays([*batch.select(others).columns, pa.array(out.view(np.int64))], names=[*others, "fp"])

    return run


def _rotated(fp: np.ndarray, start: int) -> np.ndarray:
    """The ring with segment `start` at the lowest bits."""
    k = U64(WIDTH * start)
    return fp if start == 0 else (fp >> k) | (fp << (U64(BITS) - k))


def ring_keys(fp: np.ndarray) -> np.ndarray:
    """(24, n) keys: start, choice and four equal segments of the chain that begins there."""
    out = []
    for start in range(SEGMENTS):
        ring = _rotated(fp, start)
        segment = [(ring >> U64(WIDTH * k)) & U64(2**WIDTH - 1) for k in range(5)]
        for n, choice in enumerate(CHOICES):
            key = np.full(len(fp), start * len(CHOICES) + n, U64)
            for k in choice:
                key = (key << U64(WIDTH)) | segment[k]
            out.append(key)
    return np.array(out, U64)


def within_budget(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Which pairs keep the proportional budget on every prefix of the chain from segment `start`."""
    diff = _rotated(a ^ b, start)
    ok, spent = np.ones(len(diff), bool), np.zeros(len(diff), np.int64)
    for k in range(SEGMENTS):
        spent += np.bitwise_count((diff >> U64(WIDTH * k)) & U64(2**WIDTH - 1))
        ok &= spent * SEGMENTS <= (k + 1) * DISTANCE
    return ok


def free_segments(code: int, fifth: int | None = None) -> list[int]:
    """The segments in which fingerprints under one key may differ; `fifth` numbers the one that a split makes equal."""
    start, choice = divmod(code, len(CHOICES))
    equal = {(start + k) % SEGMENTS for k in CHOICES[choice]}
    free = [k for k in range(SEGMENTS) if k not in equal]
    return [k for n, k in enumerate(free) if n != fifth]


def split_keys(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """(4, n) keys of five equal segments for fingerprints under keys of four; a pair within 3 bits shares one."""
    code, out = (key >> U64(WIDTH * EQUAL)).astype(np.int64), np.empty((SEGMENTS - EQUAL, len(fp)), U64)
    for c in np.unique(code).tolist():
        at = code == c
        segments = key[at] & U64(2 ** (WIDTH * EQUAL) - 1)
        for n, k in enumerate(free_segments(c)):
            fifth = (fp[at] >> U64(WIDTH * k)) & U64(2**WIDTH - 1)
            out[n, at] = (U64(c * len(out) + n) << U64(WIDTH * EQUAL_SPLIT)) | (segments << U64(WIDTH)) | fifth
    return out


def _flips(free: list[int]) -> np.ndarray:
    """The differences of 1 to 3 bits within these segments."""
    bits = [k for k in range(BITS) if k // WIDTH in free]
    return np.array([sum(1 << k for k in c) for n in range(1, DISTANCE + 1) for c in combinations(bits, n)], U64)


def bucket_links(fp: np.ndarray, code: int, fifth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within one key's distinct fingerprints, all that the key lets meet.

    The chain of budgets prunes all candidates before the full count. In a large bucket the candidates
    are looked up, since the differences that a key allows are fewer than the fingerprints under it.
    """
    n = len(fp)
    start = code // len(CHOICES)
    parent = np.arange(n)

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(i: int, j: int) -> bool:
        a, b = top(i), top(j)
        parent[max(a, b)] = min(a, b)
        return a != b

    left, right = [], []

    def keep(i: int, j: int) -> None:
        if link(i, j):
            left.append(fp[i])
            right.append(fp[j])

    if n < LOOKUP_FROM:
        for i in range(n - 1):
            rest = fp[i + 1 :]
            meet = np.flatnonzero(within_budget(np.broadcast_to(fp[i], rest.shape), rest, start))
            for j in meet[np.bitwise_count(rest[meet] ^ fp[i]) <= DISTANCE].tolist():
                keep(i, i + 1 + j)
    else:
        order = np.sort(fp)
        index = np.argsort(fp, kind="stable")
        for flip in _flips(free_segments(code, fifth)):
            other = fp ^ flip
            at = np.minimum(np.searchsorted(order, other), n - 1)
            found = np.flatnonzero((order[at] == other) & (other > fp))
            found = found[within_budget(fp[found], other[found], start)]
            for i in found[np.bitwise_count(fp[found] ^ other[found]) <= DISTANCE].tolist():
                keep(i, int(index[at[i]]))
    return np.array(left, U64), np.array(right, U64)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
        if len(fp):
            keys = ring_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(fp, len(keys)).view(np.int64))], names=["key", "fp"])


def _split_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, fp = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for k in ("key", "fp"))
        if len(fp):
            keys = split_keys(key, fp)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(fp, len(keys)).view(np.int64))], names=["key", "fp"])


def _link_batches(batches: Iterator[pa.RecordBatch], equal: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; a key's rows may go on in the next batch. Keys have 4 equal segments, or 5 where they are split."""
    fifths = 1 if equal == EQUAL else SEGMENTS - EQUAL

    def read(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and choice of keys as one number, and which segment a split added."""
        return np.divmod((key >> U64(WIDTH * equal)).astype(np.int64), fifths)

    def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(cut)
        u, v = [], []
        # All keys with two fingerprints at once.
        two = cut[:-1][size == 2]
        start = read(key[two])[0] // len(CHOICES)
        for k in range(SEGMENTS):
            at = two[start == k]
            a, b = fp[at], fp[at + 1]
            ok = within_budget(a, b, k)
            ok &= np.bitwise_count(a ^ b) <= DISTANCE
            u.append(a[ok])
            v.append(b[ok])
        for at, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            code, fifth = (int(x) for x in read(key[at]))
            a, b = bucket_links(fp[at : at + n], code, None if equal == EQUAL else fifth)
            u.append(a)
            v.append(b)
        if sum(map(len, u)):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u).view(np.int64)), pa.array(np.concatenate(v).view(np.int64))], names=["u", "v"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        key, fp = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for k in ("key", "fp"))
        if not len(key):
            continue
        if key[0] != key[-1] or held and held[-1][0][-1] != key[0]:
            last = int(np.flatnonzero(key == key[-1])[0])
            held.append((key[:last], fp[:last]))
            yield from links(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            held, key, fp = [], key[last:], fp[last:]
        held.append((key, fp))
    if held:
        yield from links(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))


def fingerprint_links(distinct: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """distinct(fp long) -> (u, v): links between fingerprints that join all that are within 3 bits."""
    keyed = arrow_map(distinct.select("fp"), _key_batches, "key long, fp long")

    def linked(rows: DataFrame, equal: int) -> DataFrame:
        dealt = rows.repartition("key").sortWithinPartitions("key")
        return arrow_map(dealt, partial(_link_batches, equal=equal), "u long, v long")

    hot = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= split_from).select("key"))
    if hot.isEmpty():
        return linked(keyed, EQUAL)
    hot = sent_if_few(hot)
    split = arrow_map(keyed.join(hot, "key", "left_semi"), _split_batches, "key long, fp long")
    return linked(keyed.join(hot, "key", "left_anti"), EQUAL).unionByName(linked(split, EQUAL_SPLIT))


def component_roots(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """distinct(fp) and links(u, v) -> (fp, root): every fingerprint with the smallest one of its component."""
    component = connected_components(links).withColumnRenamed("node", "fp")
    return distinct.join(component, "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, split_from: int = SPLIT_FROM) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, fingerprint (16 hex digits), component_id; one row per input row.

    Lower-cases A-Z, splits words at space, tab, LF, VT, FF and CR. Null and empty texts have
    fingerprint zero and are linked like any other. component_id is the smallest doc_id reachable
    over links of at most 3 differing bits; rows with a null doc_id take part, but never name a
    component unless all its ids are null. Repeated rows keep their number.
    """
    rows = checkpointed(arrow_map(docs.select("doc_id", "text"), _fingerprint_batches(shingle), "doc_id long, fp long"))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = rows.select("fp").distinct()
    labelled = component_roots(distinct, fingerprint_links(distinct, split_from)).join(least, "fp")
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    names = labelled.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
