"""Near-dedup for pipelines: five-word shingles, Jaccard similarity of 0.8 or more, decided exactly.

A document's set of word shingles has a 512-bit SimHash fingerprint and 24 bands of 5 min-hashes. For sets of
Jaccard similarity s the share of differing bits is about acos(2s / (1 + s)) / pi, 77 bits at s = 0.8 with a
standard deviation of 8 bits; sets of 4 and 5 shingles are the worst case, with 96 and 9. Documents that
share a band and differ in at most 140 bits are candidates, which loses fewer than one in 10**6 of the pairs at
0.8 and more. Their shingle sets are then compared, and a pair links only if the similarity is at least 0.8.
What differs in at most 3 bits of the 64-bit fingerprint (`simhash`) is a candidate too.

At this radius no exact segment key stays selective, so what is compared are documents that share
a band; of 24 bands at least one is shared with probability 0.99993 at s = 0.8 and more above. The pigeonring
chains of the ring of 8 words then prune before the full Hamming check.

No task holds a large group whole. A band of very many sets is not linked by one task but taken as one group; a group of many
bytes is compared in blocks: all of its sets with a few pivots, and then those outside of its largest component
with all others, block by block, where sets that are linked already are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import U64, arrow_map, checkpointed, column_bytes, mix, one_of_each, sent_if_few, xxh_id
from tidegate.llm.components import connected_components
from tidegate.llm.simhash import component_roots, fingerprint, fingerprint_links, shingles

SHINGLE, WORDS, RADIUS = 5, 8, 140
BANDS, DEPTH = 24, 5
#: Budgets are checked along chains of this many segments before all bits are counted.
CHAIN = 3
#: A band of this many sets (72 bytes each) is not linked in one task, but handed on as one group.
BAND_ROWS = 200_000
#: A group whose shingle hashes take more bytes is compared in blocks of about this size.
GROUP_BYTES = 64 << 20
#: Sets of a large group that are compared with all others first, and from how many linked sets on a block indexes them apart.
PIVOTS, APART = 16, 64
_CHUNK = 4096
_STEP = 0x9E3779B97F4A7C15
_BIT_SEEDS = mix(np.array([_STEP * k % 2**64 for k in range(1, WORDS + 1)], U64))
_FACTORS = mix(np.array([_STEP * k % 2**64 for k in range(101, 101 + BANDS * DEPTH)], U64)) | U64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """The hashes of a text's five-word shingles, ascending, each once."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles(text, SHINGLE)), U64))


def sketch(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8 words of the wide fingerprint, band keys) of a shingle set; all zero bits and no bands for an empty one."""
    if not len(hashed):
        return np.zeros(WORDS, U64), np.zeros(0, U64)
    ones, least = np.zeros(64 * WORDS, np.int64), np.full(BANDS * DEPTH, U64(2**64 - 1))
    for k in range(0, len(hashed), _CHUNK):
        part = hashed[k : k + _CHUNK]
        bits = np.unpackbits(np.ascontiguousarray(mix(part[:, None] + _BIT_SEEDS)).view(np.uint8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint16)
        np.minimum(least, (part * _FACTORS[:, None]).min(axis=1), out=least)
    keys = np.arange(1, BANDS + 1, dtype=U64)
    for column in least.reshape(BANDS, DEPTH).T:
        keys = mix(keys * U64(_STEP) + column)
    return np.packbits(2 * ones > len(hashed)).view(U64), keys


def within_radius(diff: np.ndarray) -> np.ndarray:
    """diff (n, 8): which rows have at most RADIUS bits set, chains of segments before the full count."""
    segments = np.bitwise_count(diff).astype(np.int64)
    chain, spent = np.ones(segments.shape, bool), np.zeros(segments.shape, np.int64)
    for k in range(CHAIN):
        spent += np.roll(segments, -k, axis=1)
        chain &= spent * WORDS <= (k + 1) * RADIUS
    ok = chain.any(axis=1)
    ok[ok] = segments[ok].sum(axis=1) <= RADIUS
    return ok


def band_links(wide: np.ndarray) -> tuple[list[int], list[int]]:
    """Links (row, row) that connect all rows of one band within the radius.

    Rows reached are followed up against those not yet reached, so a tight group costs one pass
    and the links form a forest.
    """
    left, right = [], []
    rest, todo = np.arange(len(wide)), []
    while len(rest):
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
        at = todo.pop()
        near = within_radius(wide[rest] ^ wide[at])
        found = rest[near].tolist()
        left += [at] * len(found)
        right += found
        todo += found
        rest = rest[~near]
    return left, right


def similar_pairs(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links (row, row) that connect all non-empty sets whose Jaccard similarity is at least 0.8, as a forest."""
    left, right = [], []
    size = np.array([len(x) for x in sets], np.int64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat, cut = flat.astype(np.int32), np.concatenate([[0], np.cumsum(size)])
    of = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    mark = np.zeros(len(values), bool)
    rest, todo = np.flatnonzero(size), []
    flat = flat if len(rest) else flat[:0]
    while len(rest):
        if not todo:
            at, rest, flat = int(rest[0]), rest[1:], flat[size[rest[0]] :]
        else:
            at = todo.pop()
        if not len(rest):
            break
        mark[of[at]] = True
        both = np.add.reduceat(mark[flat], np.cumsum(size[rest]) - size[rest], dtype=np.int64)
        mark[of[at]] = False
        near = 9 * both >= 4 * (size[at] + size[rest])  # both / (sum of sizes - both) >= 4 / 5
        if near.any():
            found = rest[near].tolist()
            left += [at] * len(found)
            right += found
            todo += found
            flat = flat[np.repeat(~near, size[rest])]
            rest = rest[~near]
    return left, right


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        raw, cut = data.tobytes(), offs.tolist()
        fps, ids, wide, bands, words = [], [], [], [], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            text = raw[a:b]
            fps.append(fingerprint(text))
            hashed = shingle_set(text)
            ids.append(xxhash.xxh64_intdigest(hashed.tobytes(), 42))
            bits, keys = sketch(hashed)
            wide.append(bits.tobytes())
            bands.append(keys.view(np.int64))
            words.append(len(hashed))
        fp, ids = (pa.array(np.array(x, U64).view(np.int64)) for x in (fps, ids))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), fp, ids, pa.array(wide, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(words, pa.int64())], names=["doc_id", "th", "fp", "sid", "wide", "bands", "words"])


def _group_ids(a: list[int], b: list[int], ids: np.ndarray) -> np.ndarray:
    """For each link of a forest, a number of its tree made from all of its ids, the same wherever they stand."""
    root: dict[int, int] = {}
    for x, y in zip(a, b, strict=True):
        root[y] = root.setdefault(x, x)
    total = dict.fromkeys(root.values(), 0)
    for x, y in zip(root, mix(ids[list(root)].view(U64)).tolist(), strict=True):
        total[root[x]] = (total[root[x]] + y) % 2**64
    return np.array([total[root[x]] for x in a], U64).view(np.int64)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band key; a key's rows may go on in the next batch. Links come with the number of their group."""

    def links(key: np.ndarray, fp: np.ndarray, wide: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        two = two[within_radius(wide[two] ^ wide[two + 1])]
        u, v = [fp[two]], [fp[two + 1]]
        group = [(mix(u[0].view(U64)) + mix(v[0].view(U64))).view(np.int64)]
        for at, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            a, b = band_links(wide[at : at + n])
            u.append(fp[at : at + n][a])
            v.append(fp[at : at + n][b])
            group.append(_group_ids(a, b, fp[at : at + n]))
        u, v, group = np.concatenate(u), np.concatenate(v), np.concatenate(group)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(group)], names=["u", "v", "group"])

    def joined() -> Iterator[np.ndarray]:
        return (np.concatenate(x) for x in zip(*held, strict=True))

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "fp"))
        now = (key, fp, column_bytes(batch.column("wide"))[0].view(U64).reshape(-1, WORDS))
        last = int(np.searchsorted(key, key[-1]))
        if last or held and held[-1][0][-1] != key[0]:
            held.append(tuple(x[:last] for x in now))
            yield from links(*joined())
            held, now = [], tuple(x[last:] for x in now)
        held.append(now)
    if held:
        yield from links(*joined())


def candidate_groups(rows: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """rows(fp long, sid long, wide binary, bands array<long>) -> (group, sid): sets that may be similar share a group.

    Groups are what the loose radius links within one band; those of the same members in several bands are one.
    A band of band_rows sets or more is a group as it is. Sets whose 64-bit fingerprints are linked by 3 bits are a group as well.
    """
    keyed = rows.select("sid", "wide", "bands").distinct().select(F.explode("bands").alias("key"), F.col("sid").alias("fp"), "wide")
    hot = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= band_rows).select("key"))
    crowded = not hot.isEmpty()
    hot = sent_if_few(hot) if crowded else hot
    linked = keyed.join(hot, "key", "left_anti") if crowded else keyed
    links = arrow_map(linked.repartition("key").sortWithinPartitions("key"), _link_batches, "u long, v long, group long")
    wide = links.select("group", F.explode(F.array("u", "v")).alias("sid"))
    if crowded:
        wide = wide.unionByName(keyed.join(hot, "key", "left_semi").select(F.col("key").alias("group"), F.col("fp").alias("sid")))
    fps = rows.select("fp").distinct()
    roots = component_roots(fps, fingerprint_links(fps)).join(rows.select("fp", "sid").distinct(), "fp").select("root", "sid").distinct()
    several = roots.groupBy("root").agg(F.count("*").alias("n")).where("n > 1")
    return wide.unionByName(roots.join(several, "root").select(F.xxhash64("root").alias("group"), "sid")).distinct()


def _exact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, sid, text) sorted by group, which may go on in the next batch -> links of similar sets."""
    now, ids, sets = None, [], []

    def links() -> Iterator[pa.RecordBatch]:
        if len(ids) > 1:
            a, b = similar_pairs(sets)
            at = np.array(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at[a]), pa.array(at[b])], names=["u", "v"])

    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        raw, cut = data.tobytes(), offs.tolist()
        for k, (group, sid) in enumerate(zip(batch.column("group").to_pylist(), batch.column("sid").to_pylist(), strict=True)):
            if group != now:
                yield from links()
                now, ids, sets = group, [], []
            ids.append(sid)
            sets.append(shingle_set(raw[cut[k] : cut[k + 1]]))
    yield from links()


class HeldSets:
    """Sets that others are compared with: values with the sets that hold them, one index for each large root and one for the rest."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray]]) -> None:
        by_root: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for row in rows:
            by_root.setdefault(row[1], []).append(row)
        loose = [row for group in by_root.values() if len(group) < APART for row in group]
        groups = [(root, group) for root, group in by_root.items() if len(group) >= APART]
        self.parts = [(root, *self._index(group)) for root, group in [*groups, (None, loose)] if group]
        self.top: dict[int, int] = {}

    @staticmethod
    def _index(rows: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, ...]:
        sids, roots = (np.array([row[k] for row in rows], np.int64) for k in (0, 1))
        size = np.array([len(row[2]) for row in rows], np.int64)
        flat = np.concatenate([row[2] for row in rows])
        order = np.argsort(flat, kind="stable")
        values, first = np.unique(flat[order], return_index=True)
        return sids, roots, size, values, np.append(first, len(flat)), np.repeat(np.arange(len(rows), dtype=np.int32), size)[order]

    def similar(self, root: int, hashed: np.ndarray) -> list[int]:
        """The ids of the sets of other roots with a Jaccard similarity of at least 0.8."""
        out: list[int] = []
        for alone, sids, roots, size, values, cut, holders in self.parts:
            if alone is not None and alone == root:
                continue
            at = np.minimum(np.searchsorted(values, hashed), len(values) - 1)
            at = at[values[at] == hashed]
            n = cut[at + 1] - cut[at]
            if not len(n):
                continue
            place = np.arange(n.sum()) + np.repeat(cut[at] - np.cumsum(n) + n, n)
            both = np.bincount(holders[place], minlength=len(sids))
            out += sids[(9 * both >= 4 * (size + len(hashed))) & (roots != root)].tolist()  # both / (sum of sizes - both) >= 4 / 5
        return out

    def _find(self, x: int) -> int:
        while (up := self.top.setdefault(x, x)) != x:
            self.top[x] = self.top[up]
            x = self.top[x]
        return x

    def links(self, sid: int, root: int, hashed: np.ndarray) -> list[tuple[int, int]]:
        """Links of a set that join it to all of its similar ones; those that earlier links joined to one another need one only."""
        out, seen = [], set()
        for other in self.similar(root, hashed):
            top = self._find(other)
            if top not in seen:
                seen.add(top)
                out.append((other, sid))
        for top in seen:
            self.top[top] = min(seen)
        return out


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, passes, sid, root, text) sorted by cell and passes -> links of sets that pass with those held in their cell."""
    now, rows, held = None, [], None
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        raw, cut = data.tobytes(), offs.tolist()
        out: list[tuple[int, int]] = []
        for k, (cell, passes, sid, root) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("cell", "passes", "sid", "root")), strict=True)):
            if cell != now:
                now, rows, held = cell, [], None
            hashed = shingle_set(raw[cut[k] : cut[k + 1]])
            if not len(hashed):
                continue
            if not passes:
                rows.append((sid, root, hashed))
                continue
            if rows and held is None:
                held, rows = HeldSets(rows), []
            if held is not None:
                out += held.links(sid, root, hashed)
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def large_group_links(members: DataFrame, texts: DataFrame, group_bytes: int) -> DataFrame:
    """members(group, sid, th, words, blocks), texts(th, text) -> (u, v): links that join all similar sets of each group.

    A task holds PIVOTS sets, or about group_bytes of the sets outside of the group's largest component, and streams the others.
    """

    def compared(held: DataFrame, passing: DataFrame) -> DataFrame:
        both = held.withColumn("passes", F.lit(False)).unionByName(passing.withColumn("passes", F.lit(True)))
        dealt = both.select(F.xxhash64("group", "cut", "block").alias("cell"), "passes", "sid", "root", "th").join(texts, "th").drop("th")
        return arrow_map(dealt.repartition("cell").sortWithinPartitions("cell", "passes"), _cell_batches, "u long, v long")

    def each(n: str, name: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(name)

    row = ["group", "sid", "th"]
    members = members.withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))
    first = members.withColumn("_r", F.row_number().over(Window.partitionBy("group").orderBy("sid"))).where(F.col("_r") <= PIVOTS)
    own, no_cut = F.col("sid").alias("root"), F.lit(0).cast("long").alias("cut")
    near = checkpointed(compared(first.select(*row, own, no_cut, each("blocks", "block")), members.select(*row, own, no_cut, "block")))
    component = connected_components(near).withColumnsRenamed({"node": "sid", "component": "root"})
    placed = checkpointed(members.join(component, "sid", "left").withColumn("root", F.coalesce("root", "sid")))
    main = placed.groupBy("group", "root").agg(F.count("*").alias("n")).groupBy("group").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    rest = checkpointed(placed.join(sent_if_few(checkpointed(main)), "group").where("root <> main").drop("main"))
    cuts = sent_if_few(checkpointed(rest.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.sum("words") * 8 / group_bytes)).cast("long").alias("cuts"))))
    held = rest.join(cuts, "group").withColumn("cut", F.pmod(F.xxhash64(F.lit(1), "sid"), "cuts"))
    passing = placed.join(cuts, "group").select(*row, "root", each("cuts", "cut"), "block")
    return near.unionByName(compared(held.select(*row, "root", "cut", each("blocks", "block")), passing))


def similar_links(rows: DataFrame, docs: DataFrame, band_rows: int = BAND_ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """rows as sketched, docs(th long, text) -> (u, v): links that join all candidates of similarity 0.8 or more."""
    one = rows.groupBy("sid").agg(F.min("th").alias("th"), F.max("words").alias("words"))
    members = checkpointed(candidate_groups(rows, band_rows).join(one, "sid"))
    texts = docs.join(members.select("th").distinct(), "th", "left_semi").dropDuplicates(["th"])

    def linked(some: DataFrame) -> DataFrame:
        dealt = some.join(texts, "th").select("group", "sid", "text").repartition("group").sortWithinPartitions("group")
        return arrow_map(dealt, _exact_batches, "u long, v long")

    blocks = F.ceil(F.sum("words") * 8 / group_bytes).cast("long")
    large = checkpointed(members.groupBy("group").agg(blocks.alias("blocks")).where("blocks > 1"))
    if large.isEmpty():
        return linked(members)
    large = sent_if_few(large)
    return linked(members.join(large, "group", "left_anti")).unionByName(large_group_links(members.join(large, "group"), texts, group_bytes))


def near_dedup(docs: DataFrame, band_rows: int = BAND_ROWS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs(doc_id, text, ...) with one row of each near-duplicate group, that of smallest doc_id; all columns unchanged.

    Groups are what links join over any number of steps: pairs of Jaccard similarity 0.8 or more of their
    five-word shingle sets. Null and empty texts have no shingles and form one group; a text of
    fewer words than a shingle has its whole sequence as the only one. A null id is larger than any other.
    Of rows that share the smallest id, one stays: that of the smallest content hash, so the choice
    is the same on every run. An empty table gives no rows.
    """
    th = xxh_id(F.coalesce("text", F.lit("")))
    hashed = docs.select("doc_id", th.alias("th"), "text")
    rows = checkpointed(arrow_map(hashed, _sketch_batches, "doc_id long, th long, fp long, sid long, wide binary, bands array<long>, words long"))
    distinct = rows.select(F.col("sid").alias("fp")).distinct()
    roots = component_roots(distinct, similar_links(rows, hashed.select("th", "text"), band_rows, group_bytes)).withColumnRenamed("fp", "sid")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = rows.groupBy("sid").agg(F.min(least).alias("first"))
    stay = first.join(roots, "sid").groupBy("root").agg(F.min("first").alias("stay"))
    stay = roots.join(stay, "root").select("sid", "stay")
    judged = rows.join(stay, "sid").select("doc_id", "th", least.eqNullSafe(F.col("stay")).alias("stays"))
    return one_of_each(docs, judged, th)
