"""Removal of repeated byte strings, by run-length compressed suffix indexes.

A 400-byte string is assigned to the smallest-hash 64-byte gram inside it, its anchor. Equal strings
have equal anchors at equal places, so every repeat meets under an anchor's content, and the
strings assigned to one anchor occurrence are the starts of one short context. Contexts that
occur twice are repeated whole; of anchors with several different contexts, one copy of each is
brought together and indexed:

* the contexts of a batch of anchors are one text, its Burrows-Wheeler transform is reduced to runs,
  and suffix positions with their longest common prefixes are sampled at run ends only;
* inside a run, going back by one character lengthens the match by one, so a stream over the text
  in order recovers the matching statistic of every position (the longest match with any other
  place) from the samples;
* positions whose statistic reaches 400 start a repeated string.

The contexts under one anchor are nearly the same, which is where a run-compressed index is small.
An anchor with very many different contexts is split by the place of the anchor in the string and by
the bytes that all strings of that part share. What is equal within a part is counted on the map side and
indexed once; a part that still has very many different contents, as the edges of a passage have that stands in very
many documents, is split once more into its single strings, which are counted and need no
index. So no task has to hold the contexts of an anchor whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import U64, Powers, arrow_map, checkpointed, column_bytes, mix, prefix_hash, range_hash, row_blocks

LENGTH, GRAM = 400, 64
#: From this many different contexts on, an anchor is split by parts of PART starts, and such a part by its starts. The result is the same.
SPLIT_FROM, PART = 4096, 16
INDEX_BYTES = 1_500_000
_SEGMENT = 1 << 23
_PLACE = U64((1 << 24) - 1)


class _OtherPowers(Powers):
    BASE = 0xC2B2AE3D27D4EB4F | 1


_OTHER = _OtherPowers()


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[p : p + width] for every p where that fits."""
    n = len(values)
    pad = -n % width
    grid = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, U64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchor occurrences of a block of rows: row, start and last (the assigned strings' starts), anchor, key, two content hashes."""
    with np.errstate(over="ignore"):
        n = len(data)
        names = ("row", "start", "last", "anchor", "key", "ctx_a", "ctx_b")
        if n < length:
            return {k: np.zeros(0, U64 if k in ("key", "ctx_a", "ctx_b") else np.int64) for k in names}
        prefix = prefix_hash(data)
        at = np.arange(n - gram + 1)
        grams = range_hash(prefix, at, at + gram)
        size = offs[1:] - offs[:-1]
        edge = np.zeros(n + 1, np.int32)
        long = size >= length
        np.add.at(edge, offs[:-1][long], 1)
        np.add.at(edge, offs[1:][long] - length + 1, -1)
        valid = np.cumsum(edge[:-1]) > 0
        starts, lasts, places = [], [], []
        for lo in range(0, n - length + 1, _SEGMENT):
            hi = min(lo + _SEGMENT, n - length + 1)
            window = grams[lo : hi + length - gram]
            least = _sliding_least((window & ~_PLACE) | np.arange(len(window), dtype=U64), length - gram + 1)
            place = (least & _PLACE).astype(np.int64) + lo
            place[~valid[lo:hi]] = -1
            cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            stop = np.append(cut[1:], len(place)) - 1
            ok = place[cut] >= 0
            starts.append(cut[ok] + lo)
            lasts.append(stop[ok] + lo)
            places.append(place[cut[ok]])
        start, last, place = (np.concatenate(x) for x in (starts, lasts, places))
        row = np.searchsorted(offs, start, side="right") - 1
        up, down = _OTHER.get(n + 1)
        other = np.zeros(n + 1, U64)
        np.cumsum((data.astype(U64) + U64(7)) * up[:n], out=other[1:])
        end = last + length
        return dict(zip(names, (row, start - offs[row], last - offs[row], place - offs[row], grams[place], range_hash(prefix, start, end), mix((other[end] - other[start]) * down[start])), strict=True))


class RunLengthIndex:
    """A run-length Burrows-Wheeler transform of several texts, with samples at the ends of runs.

    texts are indexed together; each ends with a terminator of its own, so no match crosses one.
    """

    def __init__(self, texts: list[bytes]) -> None:
        joined = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        size = np.array([len(t) for t in texts])
        self.base = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        sym = joined.astype(np.uint16) + 1
        sym[self.base + size] = 0
        self.n = len(sym)
        self.sym = sym
        sa, levels = self._sorted()
        before = sym[sa - 1]
        runs = np.ones(self.n + 1, bool)
        runs[1:-1] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.flatnonzero(runs[:-1])
        tails = np.flatnonzero(runs[1:])
        self.run_symbols, self.run_starts = before[heads], heads
        heads, tails = heads[heads > 0], tails[tails < self.n - 1]
        #: Sampled suffixes at run heads and tails, with their match to the row above and below.
        self.head_at, self.head_match = sa[heads], self._common(levels, sa[heads], sa[heads - 1])
        self.tail_at, self.tail_match = sa[tails], self._common(levels, sa[tails], sa[tails + 1])

    def _sorted(self) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        n, sym = self.n, self.sym
        packed, alive = np.zeros(n, np.int64), np.ones(n, bool)
        padded = np.concatenate([sym, np.zeros(7, np.uint16)])
        for k in range(7):
            s = padded[k : k + n]
            packed = packed << 9 | np.where(alive, s, 0)
            alive &= s != 0
        sa = np.argsort(packed, kind="stable")
        # Strings that reach their terminator are distinct: they stand in the order of the terminators.
        new = np.ones(n, bool)
        new[1:] = (packed[sa[1:]] != packed[sa[:-1]]) | ~alive[sa[1:]]
        rank = np.empty(n, np.int32)
        rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        levels, h = [(7, rank)], 7
        while not new.all():
            tied = ~new
            tied[:-1] |= ~new[1:]
            slots = np.flatnonzero(tied)
            at = sa[slots]
            after = rank[np.minimum(at + h, n - 1)].astype(np.int64)
            key = rank[at].astype(np.int64) * n + after
            order = np.argsort(key)
            at, key = at[order], key[order]
            sa[slots] = at
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            new[slots] = fresh
            rank = rank.copy()
            rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
            h *= 2
            levels.append((h, rank))
        return sa, levels

    def _common(self, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b, got = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for h, rank in reversed(levels):
            more = np.flatnonzero(rank[np.minimum(a, self.n - 1)] == rank[np.minimum(b, self.n - 1)])
            a[more] += h
            b[more] += h
            got[more] += h
        for _ in range(6):
            x = self.sym[np.minimum(a, self.n - 1)]
            more = np.flatnonzero((x == self.sym[np.minimum(b, self.n - 1)]) & (x != 0))
            a[more] += 1
            b[more] += 1
            got[more] += 1
        return got

    def matching_statistics(self) -> np.ndarray:
        """For every position, the length of its longest match with any other position, streamed in text order."""
        reach = np.zeros(self.n, np.int64)
        np.maximum.at(reach, self.head_at, self.head_match + self.head_at)
        np.maximum.at(reach, self.tail_at, self.tail_match + self.tail_at)
        at = np.arange(self.n)
        return np.maximum(np.maximum.accumulate(reach) - at, 0)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        for lo, _, part, cut in row_blocks(data, offs):
            a = anchors(part, cut)
            row = pa.array(a["row"] + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("th").take(row), *(pa.array(a[k].astype(np.int32)) for k in ("start", "last", "anchor")), *(pa.array(a[k].view(np.int64)) for k in ("key", "ctx_a", "ctx_b"))],
                names=["doc_id", "th", "start", "last", "anchor", "key", "ctx_a", "ctx_b"],
            )


_KEY_ONLY = "key long"
_ANCHOR = "doc_id long, th long, start int, last int, anchor int, key long, ctx_a long, ctx_b long"


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _anchor_batches(batches):
        yield batch.select(["key"])


def _context_batches(batches: Iterator[pa.RecordBatch], split: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, th, text, wanted contexts) -> a row per context, or per part of a split anchor's context."""
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        ids, hashes, wanted = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("wanted").to_pylist()
        out: list[tuple] = []
        for i in range(batch.num_rows):
            raw = data[offs[i] : offs[i + 1]].tobytes()
            for w in wanted[i]:
                if not split:
                    out.append((w["key"], raw[w["start"] : w["last"] + LENGTH], w["n"] == 1, ids[i], hashes[i], w["start"]))
                    continue
                # Part k holds the starts from anchor - (k + 1) * PART + 1 to anchor - k * PART; every string of it has `core`.
                for k in range((w["anchor"] - w["last"]) // PART, (w["anchor"] - w["start"]) // PART + 1):
                    low, high = w["anchor"] - (k + 1) * PART + 1, w["anchor"] - k * PART
                    core = raw[high : low + LENGTH]
                    key = int.from_bytes(hashlib.blake2b(core + k.to_bytes(4, "big"), digest_size=8).digest(), "big", signed=True)
                    start, last = max(low, w["start"]), min(high, w["last"])
                    out.append((key, raw[start : last + LENGTH], w["n"] == 1, ids[i], hashes[i], start))
            if len(out) >= 4096:
                yield _contexts(out)
                out = []
        if out:
            yield _contexts(out)


def _contexts(rows: list[tuple]) -> pa.RecordBatch:
    key, body, single, doc, th, start = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(body, pa.binary()), pa.array(single, pa.bool_()), pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(start, pa.int32())],
        names=["key", "body", "single", "doc_id", "th", "start"],
    )


_CONTEXT = "key long, body binary, single boolean, doc_id long, th long, start int"
_SPAN = "doc_id long, th long, start int, stop int"


def _indexed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated strings among different contents (body, single, doc_id, th, start); only single ones are reported."""
    index = RunLengthIndex([row[0] for row in rows])
    long = index.matching_statistics() >= LENGTH
    out: list[tuple] = []
    for t, (body, single, doc, th, start) in enumerate(rows):
        if not single:
            continue  # marked whole already
        count = len(body) - LENGTH + 1
        hit = np.zeros(count + 2, np.int8)
        hit[1:-1] = long[index.base[t] : index.base[t] + count]
        turn = np.flatnonzero(np.diff(hit))
        out += [(doc, th, start + a, start + b - 1 + LENGTH) for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True)]
    if out:
        doc, th, start, stop = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], names=["doc_id", "th", "start", "stop"])


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, each content once; keys are gathered whole until there is enough to index."""
    done: list[tuple] = []
    group: list[tuple] = []
    size, held, key = 0, 0, None
    for batch in batches:
        for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "body", "single", "doc_id", "th", "start")), strict=True):
            if k != key:
                if len(group) > 1 and any(x[1] for x in group):
                    done += group
                    size += held
                group, held, key = [], 0, k
                if size >= INDEX_BYTES:
                    yield from _indexed(done)
                    done, size = [], 0
            group.append(tuple(row))
            held += len(row[0])
    if len(group) > 1 and any(x[1] for x in group):
        done += group
    if done:
        yield from _indexed(done)


def _string_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a context by itself: (digest of the string, doc_id, th, start, single)."""
    for batch in batches:
        out: list[tuple] = []
        for body, single, doc, th, start in zip(*(batch.column(c).to_pylist() for c in ("body", "single", "doc_id", "th", "start")), strict=True):
            out += [(hashlib.blake2b(body[k : k + LENGTH], digest_size=16).digest(), doc, th, start + k, single) for k in range(len(body) - LENGTH + 1)]
        if out:
            digest, doc, th, start, single = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(start, pa.int32()), pa.array(single, pa.bool_())],
                names=["digest", "doc_id", "th", "start", "single"],
            )


def _index_spans(contents: DataFrame) -> DataFrame:
    return arrow_map(contents.repartition("key").sortWithinPartitions("key"), _index_batches, _SPAN)


def _split_spans(bodies: DataFrame, split_from: int) -> DataFrame:
    """Parts of split anchors' contexts (_CONTEXT) -> spans of repeated strings among the different contents of each part."""
    here = ["doc_id", "th", "start"]
    contents = checkpointed(bodies.groupBy("key", "body").agg(F.count("*").alias("times"), F.bool_and("single").alias("alone"), *(F.first(c).alias(c) for c in here)))
    # A content that several contexts share is repeated whole; one that stands alone is looked up in the index of its part.
    shared = bodies.where("single").join(contents.where("times > 1").select("key", "body"), ["key", "body"], "left_semi")
    shared = shared.select(*here, (F.col("start") + F.octet_length("body")).cast("int").alias("stop"))
    hot = checkpointed(contents.groupBy("key").agg(F.count("*").alias("contents")).where(F.col("contents") >= split_from).select("key"))
    contents = contents.withColumn("single", F.col("alone") & (F.col("times") == 1)).select("key", "body", "single", *here)
    strings = arrow_map(contents.join(hot, "key"), _string_batches, "digest binary, doc_id long, th long, start int, single boolean")
    again = strings.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1").select("digest")
    strings = strings.where("single").join(again, "digest", "left_semi").select(*here, (F.col("start") + LENGTH).cast("int").alias("stop"))
    return shared.unionByName(_index_spans(contents.join(hot, "key", "left_anti"))).unionByName(strings)


def _kept_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans that may overlap) -> the maximal runs that go, and the bytes that stay."""
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        spans = batch.column("spans")
        lengths = pa.compute.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False)
        cut = np.concatenate([[0], np.cumsum(lengths)])
        flat = spans.flatten()
        start, stop = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "stop"))
        for lo, hi, part, at in row_blocks(data, offs):
            here = slice(cut[lo], cut[hi])
            base = np.repeat(at[:-1], lengths[lo:hi])
            edge = np.zeros(len(part) + 1, np.int32)
            np.add.at(edge, base + start[here], 1)
            np.add.at(edge, base + stop[here], -1)
            gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
            # A run ends with its row, even if the next row's first byte goes too.
            first = np.zeros(len(part) + 1, bool)
            first[at] = True
            opens, shuts = gone.copy(), gone.copy()
            opens[1:] &= ~gone[:-1] | first[1:-1]
            shuts[:-1] &= ~gone[1:] | first[1:-1]
            begin, end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
            row = np.searchsorted(at, begin, side="right") - 1
            runs = pa.StructArray.from_arrays([pa.array((x - at[row]).astype(np.int32)) for x in (begin, end)], names=["start", "stop"])
            count = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))]).astype(np.int32)
            left = np.concatenate([[0], np.cumsum(~gone)])[at].astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(left), pa.py_buffer(part[~gone])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(at[1:] - at[:-1], pa.int64()), pa.ListArray.from_arrays(pa.array(count), runs), kept], names=["doc_id", "n_bytes", "spans", "kept"])


def repeated_spans(docs: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """docs(doc_id, text, th) -> (doc_id, th, start, stop): byte ranges that together cover every repeated string.

    Ranges may overlap. th tells rows of one doc_id apart; rows that agree in both are copies of one another.
    """
    # Cut off from its aggregation, so that the join below has exchanges of its own, which Spark can split for a hot key.
    keys = checkpointed(arrow_map(docs, _key_batches, _KEY_ONLY).groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"))
    seen = checkpointed(arrow_map(docs, _anchor_batches, _ANCHOR).join(keys, "key"))
    context = ["key", "ctx_a", "ctx_b"]
    one = [F.first(c).alias(c) for c in ("doc_id", "th", "start", "last", "anchor")]
    contexts = checkpointed(seen.groupBy(*context).agg(F.count("*").alias("n"), *one))
    whole = seen.join(contexts.where("n > 1").select(*context), context, "left_semi")
    whole = whole.select("doc_id", "th", "start", (F.col("last") + LENGTH).cast("int").alias("stop"))
    varied = checkpointed(contexts.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1"))
    # A context is read from any one of the rows that agree in id and text.
    one_of = docs.where(F.octet_length("text") >= LENGTH)

    def bodies(test: str, split: bool) -> DataFrame:
        wanted = contexts.join(varied.where(test), "key").select("doc_id", "th", F.struct("key", "start", "last", "anchor", "n").alias("w"))
        wanted = wanted.groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.collect_list("w").alias("wanted"))
        found = one_of.join(wanted, one_of["doc_id"].eqNullSafe(wanted["_d"]) & (one_of["th"] == wanted["_t"])).select("doc_id", "th", "text", "wanted")
        return arrow_map(found, partial(_context_batches, split=split), _CONTEXT)

    out = whole.unionByName(_index_spans(bodies(f"contexts < {split_from}", False)))
    many = f"contexts >= {split_from}"
    return out if varied.where(many).isEmpty() else out.unionByName(_split_spans(checkpointed(bodies(many, True)), split_from))


def without_repeats(docs: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_bytes, spans, kept; one row per input row.

    Removes each UTF-8 byte covered by a 400-byte string that also starts anywhere else in the table,
    the same document included; strings are judged on the input. Matches never cross documents. A null
    text is empty; texts under 400 bytes lose nothing; rows that repeat another lose all of their bytes
    if they have 400 or more. Null ids are carried along. Other columns are not looked at.

    spans holds the maximal removed runs as byte ranges of the text in order, without the last byte; kept the
    remaining bytes joined. It is binary, as a run may begin or end inside of a character.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    spans = repeated_spans(docs, split_from).groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    marked = docs.join(spans, docs["doc_id"].eqNullSafe(spans["_d"]) & (docs["th"] == spans["_t"]), "left").select("doc_id", "text", "spans")
    return arrow_map(marked, _kept_batches, "doc_id long, n_bytes long, spans array<struct<start: int, stop: int>>, kept binary")


def remove_repeats(docs: DataFrame, split_from: int = SPLIT_FROM) -> DataFrame:
    """The figures of without_repeats(): doc_id, n_bytes, n_removed, n_spans, kept_sha256; one row per input row."""
    return without_repeats(docs, split_from).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
