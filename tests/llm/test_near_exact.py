"""The near-dedup stage against exact Jaccard similarity of five-word shingle sets."""

from __future__ import annotations

import itertools
import random

from tidegate.llm import near_dedup


def brute_sets(text: str) -> set[tuple[str, ...]]:
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 5 else {tuple(words)}


def similar(a: set, b: set) -> bool:
    return 5 * len(a & b) >= 4 * len(a | b)


def copies(seed: int, n: int) -> list[tuple[int, str]]:
    """Texts with copies of similarity 0.55 to 0.95 or so, half of them around 0.8."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(20, 500))]
        rows.append(" ".join(words))
        for share in (rng.choice([0.012, 0.07]), rng.uniform(0.018, 0.03)):
            now = list(words)
            for k in rng.sample(range(len(now)), max(1, round(share * len(now)))):
                now[k] = "altered"
            rows.append(" ".join(now))
    return list(enumerate(rows))


def test_exactly_those_of_four_fifths_link(spark):
    rows = copies(3, 80)
    sets = [brute_sets(t) for _, t in rows]
    label = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if a // 3 == b // 3 and label[a] != label[b] and similar(sets[a], sets[b]):
            label = [label[a] if x == label[b] else x for x in label]
    want = {label.index(k) for k in label}
    assert 90 < len(want) < 220
    assert {r["doc_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_similar_pairs_follow_links_and_leave_empty_sets():
    sets = [near_dedup.shingle_set(t.encode()) for _, t in copies(4, 12)] + [near_dedup.shingle_set(b"")] * 2
    left, right = near_dedup.similar_pairs(sets)
    parts = [set(s.tolist()) for s in sets]
    assert all(similar(parts[a], parts[b]) for a, b in zip(left, right, strict=True)) and len(set(right)) == len(right)
    label = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets) - 2), 2):
        if label[a] != label[b] and similar(parts[a], parts[b]):
            label = [label[a] if x == label[b] else x for x in label]
    assert len(sets) - len(left) == len(set(label))
