"""Groups that are split because they are hot give the same links as groups that are not."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tests.llm.test_near_exact import brute_sets, copies, similar
from tidegate.llm import near_dedup, simhash
from tidegate.llm.common import U64


def labels(n: int, links) -> list[int]:
    """The smallest row that each of n rows is linked to."""
    top = list(range(n))
    for a, b in links:
        top = [min(top[a], top[b]) if x in (top[a], top[b]) else x for x in top]
    return top


def ring(seed: int, n: int) -> np.ndarray:
    """Distinct fingerprints that share most of their bits, among them chains of links."""
    rng = np.random.default_rng(seed)
    out = {int(rng.integers(0, 2**63))}
    while len(out) < n:
        fp = int(rng.choice(np.array(sorted(out), U64)))
        for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
            fp ^= 1 << bit
        out.add(fp)
    return np.array(sorted(out), U64)


def test_a_pair_within_three_bits_meets_under_a_split_key():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**64, 3000, dtype=U64)
    flips = np.array([sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 4), replace=False)) for _ in a], U64)
    ka, kb = simhash.ring_keys(a), simhash.ring_keys(a ^ flips)
    met = np.zeros(len(a), bool)
    for x, y in zip(ka, kb, strict=True):
        both = x == y
        met |= both
        sa, sb = simhash.split_keys(x, a), simhash.split_keys(y, a ^ flips)
        assert (sa == sb).any(axis=0)[both].all()
        assert ((sa == sb).any(axis=0) <= both).all()
    assert met.all()


@pytest.mark.parametrize("lookup_from", [2, 12_000])
def test_parts_of_a_split_key_link_what_the_key_links(monkeypatch, lookup_from):
    monkeypatch.setattr(simhash, "LOOKUP_FROM", lookup_from)
    rng, code = np.random.default_rng(3), 4
    free = simhash.free_segments(code)
    fps = {0}
    while len(fps) < 40:
        segment = int(rng.choice(free))
        fps.add(int(rng.choice(np.array(sorted(fps), U64))) ^ sum(1 << (8 * segment + int(k)) for k in rng.choice(8, 2, replace=False)))
    fps = np.array(sorted(fps), U64)
    key = next(int(k[0]) for k in simhash.ring_keys(fps) if (k == k[0]).all() and int(k[0]) >> 32 == code)
    whole = simhash.bucket_links(fps, code)
    split = simhash.split_keys(np.full(len(fps), key, U64), fps)
    pairs = []
    for sub in np.unique(split).tolist():
        members = fps[(split == U64(sub)).any(axis=0)]
        if len(members) > 1:
            assert divmod(sub >> 40, 4)[0] == code
            pairs += zip(*simhash.bucket_links(members, code, (sub >> 40) % 4), strict=True)
    at = [[(int(np.searchsorted(fps, a)), int(np.searchsorted(fps, b))) for a, b in x] for x in (pairs, zip(*whole, strict=True))]
    assert labels(len(fps), at[0]) == labels(len(fps), at[1]) and len(set(labels(len(fps), at[1]))) < len(fps)


def test_split_keys_link_all_within_three_bits(spark):
    fps = ring(1, 120)
    near = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if int(fps[a] ^ fps[b]).bit_count() <= 3]
    want = labels(len(fps), near)
    assert 10 < len(set(want)) < 115
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").coalesce(2)
    links = simhash.fingerprint_links(table, 3).collect()
    place = {int(x): k for k, x in enumerate(fps.view(np.int64))}
    assert labels(len(fps), [(place[r["u"]], place[r["v"]]) for r in links]) == want


def crowd(seed: int) -> list[tuple[int, str]]:
    """Two templates with many copies each, altered in one to many places, beside other texts and their copies."""
    rng = random.Random(seed)
    rows = [t for _, t in copies(seed, 15)]
    for _ in range(2):
        words = [f"t{rng.randrange(900)}" for _ in range(120)]
        for _ in range(70):
            now = list(words)
            for k in rng.sample(range(len(now)), rng.choice([1, 1, 2, 4, 7])):
                now[k] = f"x{rng.randrange(50)}"
            rows.append(" ".join(now))
    rows += ["", "", "one two"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute_labels(rows: list[tuple[int, str]]) -> list[int]:
    sets = [brute_sets(t) if t else set() for _, t in rows]
    return labels(len(rows), [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] == sets[b] or sets[a] and similar(sets[a], sets[b])])


@pytest.mark.parametrize("apart", [2, 64])
def test_held_sets_find_and_join_all_similar_ones(monkeypatch, apart):
    monkeypatch.setattr(near_dedup, "APART", apart)
    rows = [(k, t) for k, t in crowd(2) if t]
    sets = [near_dedup.shingle_set(t.encode()) for _, t in rows]
    rng = random.Random(1)
    roots = [rng.choice([k, 1000, 1001]) for k in range(len(rows))]
    held = near_dedup.HeldSets([(k, roots[k], sets[k]) for k in range(0, len(rows), 2)])
    links, near = [], []
    for k in range(1, len(rows), 2):
        want = [j for j in range(0, len(rows), 2) if roots[j] != roots[k] and similar(set(sets[j].tolist()), set(sets[k].tolist()))]
        assert sorted(held.similar(roots[k], sets[k])) == want
        near += [(j, k) for j in want]
        links += held.links(k, roots[k], sets[k])
    assert set(links) <= set(near) and len(links) < len(rows) < len(near)  # a forest
    assert labels(len(rows), links) == labels(len(rows), near)


def test_large_groups_in_blocks(spark):
    rows = crowd(6)
    want = brute_labels(rows)
    assert len(set(want)) > 20
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    kept = near_dedup.near_dedup(table, band_rows=20, group_bytes=8000)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
