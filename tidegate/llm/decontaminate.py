"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens: it hashes the tokens at its ones and ignores the others,
so a substituted token at an ignored place does not hide a passage. The three masks below are lossless
for the default rule: however 3 tokens of 16 are substituted, one mask fits somewhere between
them (tests enumerate all cases). Hashes of the corpus are joined with the benchmark's; around each hit
the two token sequences are laid side by side over the whole item, and the passage counts where
at least 80 % of 16 consecutive tokens agree. An item of fewer tokens is one window; under 5 tokens that
means all of them, and such an item counts only if it is long enough to tell (SHORT_BYTES) or the document's
whole text.

Tokens are lower-cased words; in scripts that are written without blanks each character is one.

A benchmark of up to BLOCK_TEXT bytes is sent to every task, and the corpus is read once. A larger one is
hashed where it lies and meets the corpus in one shuffle join of seed hashes, again over one reading of the
corpus for the hashes and one for the texts that were hit, so nothing grows in a task or in the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import U64, arrow_map, checkpointed, column_bytes, lowered, mix, prefix_hash, range_hash, row_blocks, word_spans

WINDOW, AGREE = 16, 0.8
#: Items of fewer tokens than SHORT count inside of a longer text only from SHORT_BYTES bytes of tokens on.
SHORT, SHORT_BYTES = 5, 24
#: Token positions that each mask reads.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 8, 10, 11), (0, 1, 2, 4, 5, 6))
BLOCK_TEXT = 2 << 20
_BITS = 20
_SALT = mix(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def _unspaced(data: np.ndarray) -> np.ndarray:
    """Where a three-byte character of a script without blanks starts: U+2E80 to U+9FFF, Thai, Lao, Burmese, Khmer, compatibility ideographs."""
    out = np.zeros(len(data), bool)
    if len(data) > 2:
        lead, after = data[:-2], data[1:-1]
        out[:-2] = (lead >= 0xE3) & (lead <= 0xE9) | (lead == 0xE2) & (after >= 0xBA) | (lead == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
        out[:-2] |= (lead == 0xE1) & ((after >= 0x80) & (after <= 0x82) | (after >= 0x9E) & (after <= 0x9F)) | (lead == 0xEF) & (after >= 0xA4) & (after <= 0xAB)
    return out


def token_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of rows, split further at each character of a script without blanks: (starts, ends, row of each)."""
    start, end, row = word_spans(data, offs)
    alone = _unspaced(data)
    if alone.any():
        cut = np.zeros(len(data) + 1, bool)
        at = np.flatnonzero(alone)
        cut[at] = cut[at + 3] = True
        cut[start] = True
        word = np.zeros(len(data) + 1, np.int8)
        word[start] += 1
        word[end] -= 1
        start = np.flatnonzero(cut[:-1] & (np.cumsum(word[:-1]) > 0))
        row = np.searchsorted(offs, start, side="right") - 1
        end = np.minimum(end[np.searchsorted(end, start, side="right")], np.append(start[1:], len(data)))
    return start, end, row


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased tokens of rows, where each row's begin (one more entry than rows), and their bytes per row."""
    data = lowered(data)
    start, end, row = token_spans(data, offs)
    with np.errstate(over="ignore"):
        hashed = range_hash(prefix_hash(data), start, end)
    return hashed, np.searchsorted(row, np.arange(len(offs))), np.bincount(row, end - start, len(offs) - 1).astype(np.int64)


def _seed(hashes: np.ndarray, positions: tuple[int, ...], at: np.ndarray, code: int) -> np.ndarray:
    total = np.full(len(at), code, U64)
    with np.errstate(over="ignore"):
        for k, p in enumerate(positions):
            total += hashes[at + p] * _SALT[k]
        return mix(total)


def _rule(length: int) -> tuple[int, int]:
    """(window, tokens of it that have to agree) for an item of so many tokens."""
    window = min(WINDOW, length)
    return window, math.ceil(AGREE * window)


def _parts(length: int) -> list[tuple[int, int]]:
    """Cuts of a window into parts of which the allowed substitutions leave one intact."""
    window, agree = _rule(length)
    parts = window - agree + 1
    edges = [window * k // parts for k in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _run_code(run: int, whole: bool) -> int:
    return 200 + run if whole else 100 + run


def _seeds(hashes: np.ndarray, begin: np.ndarray, long: bool, runs: set[tuple[int, bool]], wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, seeds) of a block's tokens under the masks and under runs (length, only of rows of that length); wanted filters by top bits."""
    row_of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    every = [(mask, m, False) for m, mask in enumerate(MASKS) if long] + [(tuple(range(run)), _run_code(run, whole), whole) for run, whole in sorted(runs)]
    for mask, code, whole in every:
        at = begin[:-1][np.diff(begin) == len(mask)] if whole else np.arange(max(0, len(hashes) - mask[-1]))
        key = _seed(hashes, mask, at, code)
        keep = row_of[at] == row_of[at + mask[-1]]
        if wanted is not None:
            keep &= wanted[(key >> U64(64 - _BITS)).astype(np.int64)]
        if keep.any():
            yield at[keep], key[keep]


class Benchmark:
    """The seed hashes of a block of items, sorted, with a bit filter before the search."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        data, offs = column_bytes(pa.array(texts, pa.string()))
        self.ids = pa.array(ids, pa.int64())
        self.hashes, self.begin, size = tokens(data, offs)
        #: Items that count only as a document's whole text.
        self.whole_only = (np.diff(self.begin) < SHORT) & (size < SHORT_BYTES)
        #: Contiguous seeds for items under one window, split so that the allowed substitutions leave a part intact.
        self.runs: set[tuple[int, bool]] = set()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        short: dict[tuple[int, bool], list[int]] = {}
        for item in range(len(ids)):
            a, b = int(self.begin[item]), int(self.begin[item + 1])
            if b - a >= WINDOW:
                for m, mask in enumerate(MASKS):
                    at = np.arange(a, b - mask[-1])
                    found.append((_seed(self.hashes, mask, at, m), at))
            elif b > a:
                for s, e in _parts(b - a):
                    short.setdefault((e - s, bool(self.whole_only[item])), []).append(a + s)
        for (run, whole), places in sorted(short.items()):
            at = np.array(places)
            found.append((_seed(self.hashes, tuple(range(run)), at, _run_code(run, whole)), at))
            self.runs.add((run, whole))
        keys = np.concatenate([f[0] for f in found]) if found else np.zeros(0, U64)
        place = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys, self.place = keys[order], place[order]
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(keys >> U64(64 - _BITS)).astype(np.int64)] = True
        self.long = bool((np.diff(self.begin) >= WINDOW).any())

    def overlaps(self, hashes: np.ndarray, begin: np.ndarray, *_) -> list[tuple[int, int, int, int, int]]:
        """(row, item, agreeing tokens, tokens laid side by side, first token) of every verified passage."""
        row_of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        doc_at, item_at = [], []
        for at, key in _seeds(hashes, begin, self.long, self.runs, self.filter):
            low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
            times = high - low
            at, low, times = at[times > 0], low[times > 0], times[times > 0]
            doc_at.append(np.repeat(at, times))
            item_at.append(self.place[np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)])
        if not doc_at:
            return []
        i, j = np.concatenate(doc_at), np.concatenate(item_at)
        item, row = np.searchsorted(self.begin, j, "right") - 1, row_of[i]
        laid = np.unique(np.stack([row, item, i - j]), axis=1)
        out = []
        for k in range(0, laid.shape[1], 50_000):
            out += self._verified(hashes, begin, *laid[:, k : k + 50_000])
        return out

    def _verified(self, hashes: np.ndarray, begin: np.ndarray, row: np.ndarray, item: np.ndarray, shift: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        a, b = self.begin[item], self.begin[item + 1]
        size = b - a
        unit = np.repeat(np.arange(len(row)), size)
        first = np.cumsum(size) - size
        at = a[unit] + np.arange(len(unit)) - first[unit]
        doc = at + shift[unit]
        inside = (doc >= begin[row][unit]) & (doc < begin[row + 1][unit])
        same = np.zeros(len(unit), bool)
        same[inside] = hashes[doc[inside]] == self.hashes[at[inside]]
        total = np.concatenate([[0], np.cumsum(same)])
        window = np.minimum(size, WINDOW)
        need = np.ceil(AGREE * window - 1e-9).astype(np.int64)
        place = np.arange(len(unit)) - first[unit]
        fits = place + window[unit] <= size[unit]
        good = np.zeros(len(unit), bool)
        p = np.flatnonzero(fits)
        good[p] = total[p + window[unit[p]]] - total[p] >= need[unit[p]]
        covered = np.zeros(len(unit) + 1, np.int32)
        p = np.flatnonzero(good)
        np.add.at(covered, p, 1)
        np.add.at(covered, p + window[unit[p]], -1)
        covered = (np.cumsum(covered[:-1]) > 0) & inside
        n_covered = np.bincount(unit, covered, len(row)).astype(np.int64)
        n_same = np.bincount(unit, covered & same, len(row)).astype(np.int64)
        n_covered[self.whole_only[item] & (np.diff(begin)[row] != size)] = 0
        return [(int(row[k]), int(item[k]), int(n_same[k]), int(n_covered[k]), int(a[k] + shift[k] - begin[row[k]])) for k in np.flatnonzero(n_covered > 0)]


def _overlap_batches(bench: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            for lo, _, part, cut in row_blocks(data, offs):
                found = bench.overlaps(*tokens(part, cut))
                if found:
                    row, item, same, covered, first = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(np.array(row) + lo)), batch.column("th").take(pa.array(np.array(row) + lo)), bench.ids.take(pa.array(item)), pa.array(same, pa.int64()), pa.array(covered, pa.int64()), pa.array(first, pa.int64())],
                        names=["doc_id", "th", "item_id", "matched_tokens", "overlap_tokens", "first_token"],
                    )

    return run


_OVERLAP = "doc_id long, th long, item_id long, matched_tokens long, overlap_tokens long, first_token long"


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items with a text; ih tells texts of one id, or of none, apart."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    return items.withColumn("ih", F.xxhash64("text"))


def small_benchmark(benchmark: DataFrame, block_text: int = BLOCK_TEXT) -> Benchmark | None:
    """The benchmark's seeds, if its texts have at most block_text bytes together; otherwise None."""
    items = _items(benchmark)
    if (items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0) > block_text:
        return None
    rows = sorted(items.select("item_id", "text").collect(), key=repr)  # at most block_text bytes
    return Benchmark([r[0] for r in rows], [r[1] for r in rows])


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs that items of fewer tokens than a window need."""
    found: set[tuple[int, bool]] = set()
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            found |= Benchmark(part.column("item_id").to_pylist(), part.column("text").to_pylist()).runs
    if found:
        run, whole = zip(*sorted(found), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(run, pa.int32()), pa.array(whole, pa.bool_())], names=["run", "whole"])


def _corpus_seeds(batches: Iterator[pa.RecordBatch], runs: set[tuple[int, bool]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        for lo, _, part, cut in row_blocks(data, offs, BLOCK_TEXT // 4):
            hashes, begin, _ = tokens(part, cut)
            row_of = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            for at, key in _seeds(hashes, begin, True, runs):
                row = row_of[at]
                of = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column("doc_id").take(of), batch.column("th").take(of), pa.array((at - begin[row]).astype(np.int32))],
                    names=["key", "doc_id", "th", "at"],
                )


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            bench = Benchmark(part.column("item_id").to_pylist(), part.column("text").to_pylist())
            item = np.searchsorted(bench.begin, bench.place, "right") - 1
            of = pa.array(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bench.keys.view(np.int64)), part.column("item_id").take(of), part.column("ih").take(of), pa.array((bench.place - bench.begin[item]).astype(np.int32))],
                names=["key", "item_id", "ih", "place"],
            )


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, th, text, item_id, item, shifts) -> the verified overlaps."""
    for batch in batches:
        bench = Benchmark(batch.column("item_id").to_pylist(), batch.column("item").to_pylist())
        data, offs = column_bytes(batch.column("text"))
        shifts = batch.column("shifts")
        count = np.diff(shifts.offsets.to_numpy())
        laid = shifts.flatten().to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(count)])
        for lo, hi, part, cut in row_blocks(data, offs):
            hashes, begin, _ = tokens(part, cut)
            row = np.repeat(np.arange(hi - lo), count[lo:hi])
            # As in Benchmark.overlaps, a shift is counted from the block's first tokens.
            shift = laid[at[lo] : at[hi]] + begin[row] - bench.begin[row + lo]
            found = bench._verified(hashes, begin, row, row + lo, shift)
            if found:
                row, _, same, covered, first = zip(*found, strict=True)
                of = pa.array(np.array(row) + lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(of), batch.column("th").take(of), batch.column("item_id").take(of), pa.array(same, pa.int64()), pa.array(covered, pa.int64()), pa.array(first, pa.int64())], names=["doc_id", "th", "item_id", "matched_tokens", "overlap_tokens", "first_token"])


def _joined(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps by a shuffle join of seed hashes, for a benchmark of any size."""
    items = _items(benchmark)
    runs = {tuple(r) for r in arrow_map(items, _run_batches, "run int, whole boolean").distinct().collect()}  # two for each length under a window
    ours = arrow_map(rows, partial(_corpus_seeds, runs=runs), "key long, doc_id long, th long, at int")
    theirs = arrow_map(items, _item_seeds, "key long, item_id long, ih long, place int")
    hits = ours.join(theirs, "key").groupBy("doc_id", "th", "item_id", "ih").agg(F.collect_set(F.col("at") - F.col("place")).alias("shifts"))
    hits = checkpointed(hits).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("item_id").alias("_i"), F.col("ih").alias("_h"), "shifts")
    texts = items.select("item_id", "ih", F.col("text").alias("item"))
    hits = hits.join(texts, hits["_i"].eqNullSafe(texts["item_id"]) & (hits["_h"] == texts["ih"]))
    one = rows.join(hits.select("_d", "_t").distinct(), [rows["doc_id"].eqNullSafe(F.col("_d")), rows["th"] == F.col("_t")], "left_semi").dropDuplicates(["doc_id", "th"])
    laid = one.join(hits, one["doc_id"].eqNullSafe(hits["_d"]) & (one["th"] == hits["_t"])).select("doc_id", "th", "text", "item_id", "item", "shifts")
    return arrow_map(laid, _verify_batches, _OVERLAP)


def _found(docs: DataFrame, benchmark: DataFrame, block_text: int) -> DataFrame:
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    bench = small_benchmark(benchmark, block_text)
    return _joined(rows, benchmark) if bench is None else arrow_map(rows, _overlap_batches(bench), _OVERLAP)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_text: int = BLOCK_TEXT) -> DataFrame:
    """docs(doc_id, text, ...), benchmark(item_id, text, ...) -> one row per document and item that overlap.

    Columns: doc_id, item_id, matched_tokens, overlap_tokens, first_token (where the item would begin
    in the document, in tokens; negative if its head is cut off); of several passages the longest. Words are lower-cased runs of
    letters, digits and non-ASCII characters. Null texts, empty ones and those without tokens overlap nothing; null ids of documents and of
    items are carried along, and rows that agree in an id give one row.
    """
    best = F.max(F.struct("overlap_tokens", "matched_tokens", "first_token")).alias("b")
    return _found(docs, benchmark, block_text).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.matched_tokens", "b.overlap_tokens", "b.first_token")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_text: int = BLOCK_TEXT) -> DataFrame:
    """docs without the rows that overlap a benchmark item; all columns unchanged, repeated rows kept as often as they come.

    A null or empty text stays; a null id is as good as any other.
    """
    names = docs.columns
    bench = small_benchmark(benchmark, block_text)
    if bench is not None:
        return arrow_map(docs.select(*names), _clean_batches(bench), docs.schema)
    dirty = _found(docs, benchmark, block_text).select(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).distinct()
    keyed = docs.withColumn("_th", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(dirty, keyed["doc_id"].eqNullSafe(dirty["_d"]) & (keyed["_th"] == dirty["_t"]), "left_anti").select(*names)


def _clean_batches(bench: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            clean = np.ones(batch.num_rows, bool)
            for lo, _, part, cut in row_blocks(data, offs):
                for row, *_ in bench.overlaps(*tokens(part, cut)):
                    clean[lo + row] = False
            yield batch.filter(pa.array(clean))

    return run
