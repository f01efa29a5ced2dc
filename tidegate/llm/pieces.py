"""SentencePiece encoding and decoding with N-best segmentation.

The pieces of a text form a lattice whose edges carry the vocabulary's scores. A forward Viterbi pass
gives the best score of every prefix; a search backward from the end that adds this score to what
it has gathered (A-star with an exact heuristic) meets complete segmentations in the order of their
scores, so the first N it completes are the N best.

Where two neighbouring bytes occur together in no piece, no edge reaches across, so the lattice of a
text is a chain of small ones. The N best of the text combine alternatives of the chain's links,
of which only the N - 1 links that lose least by their second best can matter. Forward and backward
Viterbi scores, computed for all distinct links of a block at once, give every link's best path and
that loss exactly; the A-star search then runs on the few links that matter, and the
result is that of one search over the whole lattice.

The vocabulary is read on the driver, from a path given as parameter, and goes to the tasks as a list.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegate.llm.common import U64, arrow_map, column_bytes, prefix_hash, range_hash, row_blocks

N_BEST = 3
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: What a character outside of the vocabulary costs beyond the worst piece, as in the public library.
UNKNOWN_PENALTY = 10.0
#: Links of more bytes are searched one by one.
LONG = 64
#: How many links a worker remembers: with their best path, and with all of their N best.
CACHE_LINKS, CACHE_RANKED = 300_000, 50_000
_BITS = 22


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with blanks for word starts; byte pieces and control pieces apart."""

    pieces: dict[str, tuple[int, float]]
    bytes_first: int | None
    unknown: int
    raw: list[bytes] = field(repr=False)
    longest: int
    worst: float

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        rows = []
        for i in range(model.get_piece_size()):
            kind = "byte" if model.is_byte(i) else "none" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece"
            rows.append((model.id_to_piece(i), model.get_score(i), kind))
        return cls.of(rows, model.unk_id())

    @classmethod
    def of(cls, rows: list[tuple[str, float, str]], unknown: int = 0) -> Vocabulary:
        """rows: (piece with U+2581 for a blank, score, kind: piece, byte or none), in the order of ids."""
        pieces, raw, first = {}, [], None
        for i, (text, score, kind) in enumerate(rows):
            text = text.replace("▁", " ")
            if kind == "byte":
                first = i if first is None else first
                raw.append(bytes([int(text[3:5], 16)]))
            elif kind == "piece":
                pieces[text] = (i, float(score))
                raw.append(text.encode())
            else:
                raw.append(b"")
        worst = min((s for _, s in pieces.values() if s > -1e8), default=0.0)
        return cls(pieces, first, unknown, raw, max(map(len, pieces), default=1), worst)

    def edges(self, text: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For every end, the pieces that stop there: (start, ids, score)."""
        pieces, n = self.pieces, len(text)
        out: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                if (found := pieces.get(text[start:end])) is not None:
                    out[end].append((start, (found[0],), found[1]))
            if text[end - 1 : end] not in pieces:
                ids = (self.unknown,) if self.bytes_first is None else tuple(self.bytes_first + b for b in text[end - 1 : end].encode())
                out[end].append((end - 1, ids, self.worst - UNKNOWN_PENALTY))
        return out

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a piece of text as it stands, best first."""
        edges = self.edges(text)
        best = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            best[end] = max(best[start] + score for start, _, score in edges[end])
        heap: list[tuple[float, int, int, float, tuple]] = [(-best[-1], 0, len(text), 0.0, ())]
        found, count = [], 0
        while heap and len(found) < n:
            _, _, at, gathered, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                found.append((gathered, tuple(ids)))
                continue
            for start, ids, score in edges[at]:
                count += 1
                heapq.heappush(heap, (-(gathered + score + best[start]), count, start, gathered + score, (ids, path)))
        return found

    def decode(self, ids) -> str:
        """The text of a sequence of ids; what encode() made comes back exactly."""
        joined = b"".join([self.raw[i] for i in ids])
        return joined.decode("utf-8", "replace")[1:] if joined[:1] == b" " else joined.decode("utf-8", "replace")


def smallest_sums(losses: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n smallest sums of one entry per list (each ascending from 0): (sum, index per list)."""
    start = (0,) * len(losses)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        total, pick = heapq.heappop(heap)
        out.append((total, pick))
        for k in range(len(losses)):
            if pick[k] + 1 < len(losses[k]):
                after = (*pick[:k], pick[k] + 1, *pick[k + 1 :])
                if after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (total - losses[k][pick[k]] + losses[k][pick[k] + 1], after))
    return out


def changed(ids: np.ndarray, changes: list[tuple[int, tuple[int, ...], tuple[int, ...]]]) -> np.ndarray:
    """The ids of another segmentation, from those of the best and the changes that lead to it."""
    parts, end = [], 0
    for place, old, new in changes:
        parts += [ids[end:place], np.array(new, np.int32)]
        end = place + len(old)
    return np.concatenate([*parts, ids[end:]]) if parts else ids


def equal_bytes(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray, step: int = 20_000) -> np.ndarray:
    """Which of the ranges a[at : at + size] and b[bt : bt + size], none empty, hold the same bytes."""
    out = np.ones(len(at), bool)
    for k in range(0, len(at), step):
        n = size[k : k + step]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum()))
        same = a[np.repeat(at[k : k + step] - first, n) + place] == b[np.repeat(bt[k : k + step] - first, n) + place]
        out[k : k + step] = np.logical_and.reduceat(same, first)
    return out


def split_collisions(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links data[begin:end] in classes by hash (first of each class, class of each link) -> classes of equal bytes."""
    size = end - begin
    like = first[which]
    same = size == size[like]
    others = np.flatnonzero(same & (like != np.arange(len(like))))
    same[others] = equal_bytes(data, begin[others], data, begin[like[others]], size[others])
    if same.all():
        return first, which
    first, which = first.tolist(), which.copy()
    apart: dict[bytes, int] = {}
    for k in np.flatnonzero(~same).tolist():
        raw = data[begin[k] : end[k]].tobytes()
        if raw not in apart:
            apart[raw] = len(first)
            first.append(k)
        which[k] = apart[raw]
    return np.array(first), which


def _nothing_seen() -> dict[str, np.ndarray]:
    kinds = {"key": U64, "slot": np.int64, "raw_at": np.int64, "size": np.int64, "raw": np.uint8, "at": np.int64, "count": np.int64, "best": float, "loss": float, "pool": np.int32}
    return {k: np.zeros(0, kind) for k, kind in kinds.items()}


class Encoder:
    """Segments blocks of texts; made once per worker and vocabulary."""

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST) -> None:
        self.vocabulary, self.n = vocabulary, n
        self.ranked: dict[bytes, list[tuple[float, tuple[int, ...]]]] = {}
        self.seen = _nothing_seen()
        texts = [p.encode() for p in vocabulary.pieces]
        ids = np.array([i for i, _ in vocabulary.pieces.values()], np.int64)
        scores = np.array([s for _, s in vocabulary.pieces.values()])
        self.longest = max(map(len, texts), default=1)
        self.together = np.zeros((256, 256), bool)
        for t in texts:
            for x, y in zip(t, t[1:], strict=False):
                self.together[x, y] = True
        size = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(size)
        with np.errstate(over="ignore"):
            keys = range_hash(prefix_hash(np.frombuffer(b"".join(texts), np.uint8)), end - size, end)
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], ids[order], scores[order]
        #: The pieces' bytes in the order of keys: hashes find candidates, bytes decide.
        self.raw, self.raw_at = np.frombuffer(b"".join(texts), np.uint8), (end - size)[order]
        self.raw_size = size[order]
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(keys >> U64(64 - _BITS)).astype(np.int64)] = True
        self.penalty = vocabulary.worst - UNKNOWN_PENALTY

    def links(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where the links of the texts begin: at character starts whose byte pair is in no piece, and at text starts."""
        cut = np.zeros(len(data), bool)
        cut[1:] = ~self.together[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[offs[:-1][offs[:-1] < offs[1:]]] = True
        return np.flatnonzero(cut)

    def _edges(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges of the links data[begin:end]: (link, start, stop, id or -1 for an unknown character, score)."""
        size = end - begin
        link = np.repeat(np.arange(len(begin)), size)
        place = np.arange(len(link)) - np.repeat(np.cumsum(size) - size, size)
        at = begin[link] + place
        prefix = prefix_hash(data)
        found = []
        known = np.zeros(len(link), bool)
        lead = (data[at] & 0xC0) != 0x80
        width = 1 + (data[at] >= 0xC0).astype(np.int64) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
        for n in range(1, min(self.longest, int(size.max(initial=0))) + 1):
            k = np.flatnonzero(lead & (place + n <= size[link]))
            if not len(k):
                break
            key = range_hash(prefix, at[k], at[k] + n)
            ok = self.filter[(key >> U64(64 - _BITS)).astype(np.int64)]
            k, key = k[ok], key[ok]
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[where] == key) & (self.raw_size[where] == n)
            k, where = k[ok], where[ok]
            if len(k):
                ok = np.ones(len(k), bool)
                for j in range(n):
                    ok &= data[at[k] + j] == self.raw[self.raw_at[where] + j]
                if not ok.all():
                    k, where = k[ok], where[ok]
            known[k[width[k] == n]] = True
            found.append((link[k], place[k], place[k] + n, self.ids[where], self.scores[where]))
        k = np.flatnonzero(lead & ~known)
        found.append((link[k], place[k], place[k] + width[k], np.full(len(k), -1), np.full(len(k), self.penalty)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def solve(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best paths of the links data[begin:end]: (ids of all, how many of each link, best score, loss of the second best)."""
        n, size = len(begin), end - begin
        with np.errstate(over="ignore", invalid="ignore"):
            link, start, stop, ids, score = self._edges(data, begin, end)
            order = np.lexsort((start, link, stop))
            link, start, stop, ids, score = (x[order] for x in (link, start, stop, ids, score))
            wide = int(size.max()) + 1
            ahead = np.full((wide, n), -np.inf)
            ahead[0] = 0
            back = np.full((wide, n), -1)
            step = np.searchsorted(stop, np.arange(wide + 1))
            for t in range(1, wide):
                a, b = step[t], step[t + 1]
                if a == b:
                    continue
                total = ahead[start[a:b], link[a:b]] + score[a:b]
                head = np.flatnonzero(np.concatenate([[True], link[a + 1 : b] != link[a : b - 1]]))
                top = np.maximum.reduceat(total, head)
                ahead[t, link[a:b][head]] = top
                hit = np.flatnonzero(total == np.repeat(top, np.diff(np.append(head, b - a))))[::-1]
                back[t, link[a:b][hit]] = hit + a  # the first of those that are equal
            order = np.lexsort((link, start))
            behind = np.full((wide, n), -np.inf)
            behind[size, np.arange(n)] = 0
            step = np.searchsorted(start[order], np.arange(wide + 1))
            for t in range(wide - 1, -1, -1):
                e = order[step[t] : step[t + 1]]
                if len(e):
                    total = behind[stop[e], link[e]] + score[e]
                    head = np.flatnonzero(np.concatenate([[True], link[e][1:] != link[e][:-1]]))
                    top = np.maximum.reduceat(total, head)
                    behind[t, link[e][head]] = np.maximum(behind[t, link[e][head]], top)
            best = ahead[size, np.arange(n)]
            used = np.zeros(len(link), bool)
            at, todo, paths = size.copy(), np.arange(n), []
            while len(todo):
                e = back[at[todo], todo]
                used[e] = True
                paths.append(e)
                at[todo] = start[e]
                todo = todo[at[todo] > 0]
            through = ahead[start, link] + score + behind[stop, link]
            second = np.full(n, -np.inf)
            np.maximum.at(second, link[~used], through[~used])
            path = np.concatenate(paths) if paths else np.zeros(0, np.int64)
            path = path[np.lexsort((start[path], link[path]))]
        return *self._ids(data, begin, link[path], start[path], stop[path], ids[path], n), best, best - second

    def _ids(self, data: np.ndarray, begin: np.ndarray, link: np.ndarray, start: np.ndarray, stop: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Spell unknown characters in byte pieces, or as the unknown piece."""
        first = self.vocabulary.bytes_first
        times = np.where((ids < 0) & (first is not None), stop - start, 1)
        of = np.repeat(np.arange(len(ids)), times)
        out = ids[of]
        step = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        unknown = out < 0
        out[unknown] = self.vocabulary.unknown if first is None else first + data[(begin[link] + start)[of][unknown] + step[unknown]].astype(np.int64)
        return out.astype(np.int32), np.bincount(link, times, n).astype(np.int64)

    def _solved(self, data: np.ndarray, b: np.ndarray, e: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Best paths of distinct links: (ids of all, where each one's are, how many, best score, loss of the second best).

        What earlier blocks met is not solved again. Links are remembered by their bytes, at most CACHE_LINKS of them.
        """
        seen = self.seen
        place = np.searchsorted(seen["key"], keys)
        hit = place < len(seen["key"])
        hit[hit] = seen["key"][place[hit]] == keys[hit]
        slot = np.zeros(len(keys), np.int64)
        slot[hit] = seen["slot"][place[hit]]
        old = np.flatnonzero(hit)
        old = old[seen["size"][slot[old]] == (e - b)[old]]
        old = old[equal_bytes(data, b[old], seen["raw"], seen["raw_at"][slot[old]], (e - b)[old])]
        fresh = np.ones(len(keys), bool)
        fresh[old] = False
        at, count, best, loss = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), np.zeros(len(b)), np.full(len(b), np.inf)
        for name, values in (("at", at), ("count", count), ("best", best), ("loss", loss)):
            values[old] = seen[name][slot[old]]
        small, large = np.flatnonzero(fresh & (e - b <= LONG)), np.flatnonzero(fresh & (e - b > LONG))
        pools, used = [seen["pool"]], len(seen["pool"])
        if len(small):
            ids, count[small], best[small], loss[small] = self.solve(data, b[small], e[small])
            pools.append(ids)
            at[small] = used + np.cumsum(count[small]) - count[small]
            used += len(ids)
        for k in large.tolist():
            ranked = self.vocabulary.n_best(data[b[k] : e[k]].tobytes().decode(), self.n)
            count[k], best[k], at[k] = len(ranked[0][1]), ranked[0][0], used
            loss[k] = ranked[0][0] - ranked[1][0] if len(ranked) > 1 else np.inf
            pools.append(np.array(ranked[0][1], np.int32))
            used += len(ranked[0][1])
        pool = np.concatenate(pools)
        self._remember(data, b, e, keys, small, pool, at, count, best, loss)
        return pool, at, count, best, loss

    def _remember(self, data: np.ndarray, b: np.ndarray, e: np.ndarray, keys: np.ndarray, new: np.ndarray, pool: np.ndarray, at: np.ndarray, count: np.ndarray, best: np.ndarray, loss: np.ndarray) -> None:
        """Add solved links to those seen; if that would be too many, start anew from these."""
        if len(self.seen["size"]) + len(new) > CACHE_LINKS:
            self.seen = _nothing_seen()
            new = new[:CACHE_LINKS]
        seen = self.seen
        order = np.argsort(keys[new], kind="stable")
        new = new[order]
        place = np.searchsorted(seen["key"], keys[new])
        taken = np.zeros(len(new), bool)  # a link whose hash belongs to another one is not remembered
        taken[1:] = keys[new][1:] == keys[new][:-1]
        inside = place < len(seen["key"])
        taken[inside] |= seen["key"][place[inside]] == keys[new][inside]
        new, place = new[~taken], place[~taken]
        size, n = (e - b)[new], count[new]
        raw = np.repeat(b[new] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        ids = np.repeat(at[new] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        slots = len(seen["size"]) + np.arange(len(new))
        more = {"raw_at": len(seen["raw"]) + np.cumsum(size) - size, "size": size, "raw": data[raw], "at": len(seen["pool"]) + np.cumsum(n) - n, "count": n, "best": best[new], "loss": loss[new], "pool": pool[ids]}
        self.seen = {k: np.concatenate([seen[k], v]) for k, v in more.items()} | {"key": np.insert(seen["key"], place, keys[new]), "slot": np.insert(seen["slot"], place, slots)}

    def ranking(self, link: bytes) -> list[tuple[float, tuple[int, ...]]]:
        """The N best of a link, by the A-star search."""
        if (found := self.ranked.get(link)) is None:
            if len(self.ranked) >= CACHE_RANKED:
                self.ranked.clear()
            found = self.ranked[link] = self.vocabulary.n_best(link.decode(), self.n)
        return found

    def block(self, data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, list[tuple[float, list[tuple[int, tuple[int, ...], tuple[int, ...]]]]]]]:
        """For each text of a block: (ids of the best, [(score, changes)] of the N best).

        A change (place of the first id, ids of the best, ids instead) leads from the best to another one.
        """
        full = np.flatnonzero(offs[1:] > offs[:-1])
        shift = np.concatenate([[0], np.cumsum(offs[1:] > offs[:-1])])
        data, offs = np.insert(data, offs[full], np.uint8(32)), offs + shift
        if not len(full):
            yield from ((np.zeros(0, np.int32), [(0.0, [])]) for _ in range(len(offs) - 1))
            return
        begin = self.links(data, offs)
        end = np.append(begin[1:], len(data))
        with np.errstate(over="ignore"):
            hashed = range_hash(prefix_hash(data), begin, end)
        _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        first, which = split_collisions(data, begin, end, first, which)
        b, e = begin[first], end[first]
        pool, at, count, best, loss = self._solved(data, b, e, hashed[first])
        of_row = np.searchsorted(begin, offs)
        for row in range(len(offs) - 1):
            links = which[of_row[row] : of_row[row + 1]]
            if not len(links):
                yield np.zeros(0, np.int32), [(0.0, [])]
                continue
            size = count[links]
            head = np.cumsum(size) - size
            ids = pool[np.repeat(at[links] - head, size) + np.arange(int(size.sum()))]
            few = min(self.n - 1, len(links))
            lost = loss[links]
            places = np.argpartition(lost, few - 1)[:few] if few else np.zeros(0, np.int64)
            places = np.sort(places[np.isfinite(lost[places])]).tolist()
            ranked = [self.ranking(data[b[k] : e[k]].tobytes()) for k in links[places].tolist()]
            total = float(best[links].sum())
            out = []
            for less, pick in smallest_sums([[r[0][0] - s for s, _ in r] for r in ranked], self.n):
                out.append((total - less, [(int(head[places[k]]), r[0][1], r[p][1]) for k, (r, p) in enumerate(zip(ranked, pick, strict=True)) if p]))
            yield ids, out

    def encode(self, text: str) -> list[tuple[float, list[int]]]:
        """The N best segmentations of a text in full: (score, ids), best first."""
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, ranked = next(self.block(raw, np.array([0, len(raw)])))
        return [(score, changed(ids, changes).tolist()) for score, changes in ranked]


#: One encoder per worker and vocabulary, kept between tasks.
_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, n: int) -> Encoder:
    key = (n, len(vocabulary.raw), vocabulary.worst, hash(tuple(vocabulary.raw)), hash(tuple(vocabulary.pieces.values())))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, n)
    return _ENCODERS[key]


def _encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, n: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary, n)
    raw_size = np.array([len(r) for r in vocabulary.raw])
    raw_at = np.cumsum(raw_size) - raw_size
    raw = np.frombuffer(b"".join(vocabulary.raw), np.uint8)
    for batch in batches:
        data, offs = column_bytes(batch.column("text"))
        for lo, hi, part, cut in row_blocks(data, offs, 1 << 20):
            ids, count, scores = [], [], []
            for best, ranked in encoder.block(part, cut):
                ids += [changed(best, changes) for _, changes in ranked]
                count.append(len(ranked))
                scores += [s for s, _ in ranked]
            first = np.cumsum([0, *count])
            length = np.array([len(x) for x in ids], np.int64)
            flat, at = np.concatenate(ids), np.concatenate([[0], np.cumsum(length)])
            exact = []
            for row in range(hi - lo):
                text = part[cut[row] : cut[row + 1]]
                for k in range(first[row], first[row + 1]):
                    size = raw_size[ids[k]]
                    decoded = raw[np.repeat(raw_at[ids[k]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
                    exact.append(np.array_equal(decoded[1:], text))
            offsets = pa.array(first, pa.int32())
            best = pa.array(np.concatenate([ids[k] for k in first[:-1]]), pa.int32())
            every = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length[first[:-1]])]), pa.int32()), best),
                    pa.ListArray.from_arrays(offsets, every),
                    pa.ListArray.from_arrays(offsets, pa.array(scores, pa.float64())),
                    pa.ListArray.from_arrays(offsets, pa.array(length, pa.int64())),
                    pa.array(np.logical_and.reduceat(exact, first[:-1]), pa.bool_()),
                ],
                names=["doc_id", "piece_ids", "nbest_ids", "nbest_scores", "nbest_pieces", "round_trip"],
            )


def encoded(docs: DataFrame, vocabulary: Vocabulary, n: int = N_BEST) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, piece_ids, nbest_ids, nbest_scores, nbest_pieces, round_trip; one row per input row.

    piece_ids is the best segmentation of the whole text; nbest_ids, nbest_scores and nbest_pieces have the ids, score
    and number of pieces of the n best, or of all if there are fewer, best first. round_trip tells that
    decoding each of them gave the text back. A null or empty text has no pieces and one segmentation, of
    score 0. Of segmentations with equal scores, which come among the n is fixed by the search.
    """
    return arrow_map(docs.select("doc_id", "text"), partial(_encode_batches, vocabulary=vocabulary, n=n), "doc_id long, piece_ids array<int>, nbest_ids array<array<int>>, nbest_scores array<double>, nbest_pieces array<long>, round_trip boolean")


def _decode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column("piece_ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decoded(pieces: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """pieces(doc_id, piece_ids, ...) -> doc_id, text. Null ids give a null text; ids outside of the vocabulary raise IndexError."""
    return arrow_map(pieces.select("doc_id", "piece_ids"), partial(_decode_batches, vocabulary=vocabulary), "doc_id long, text string")
