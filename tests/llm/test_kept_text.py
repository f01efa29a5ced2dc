"""op2's operator gives back what is left of each text and where the rest was, not only figures of it."""

from __future__ import annotations

import random

import pytest

from tidegate.llm import suffix_dedup
from tidegate.llm.queries import queries

RNG = random.Random(11)


def prose(n):
    return "".join(RNG.choice("abcdefgh äé語") for _ in range(n))


SHARED, OTHER = prose(450), prose(420)
ROWS = [
    (1, prose(50) + SHARED + prose(60) + OTHER + prose(30)),
    (2, SHARED),
    (3, OTHER + "x" + SHARED),
    (3, prose(700)),
    (4, SHARED),
    (5, None),
    (6, ""),
    (None, prose(9) + "q" * 401 + "z"),
    (7, "é" * 150 + prose(20) + "語" * 140),
    (8, "a" + "語" * 140),
    (9, prose(399)),
]


def brute(texts, length=400):
    raw = [(t or "").encode() for _, t in texts]
    places: dict[bytes, int] = {}
    for b in raw:
        for k in range(len(b) - length + 1):
            places[b[k : k + length]] = places.get(b[k : k + length], 0) + 1
    out = []
    for (d, _), b in zip(texts, raw, strict=True):
        gone: set[int] = set()
        for k in range(len(b) - length + 1):
            if places[b[k : k + length]] > 1:
                gone.update(range(k, k + length))
        spans = []
        for k in sorted(gone):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out.append((d, len(b), tuple(map(tuple, spans)), bytes(b[k] for k in range(len(b)) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split_from", [suffix_dedup.SPLIT_FROM, 2])
def test_kept_bytes_and_spans(spark, split_from):
    docs = spark.createDataFrame([(d, t, "more") for d, t in ROWS], "doc_id long, text string, kept string").coalesce(1)
    found = suffix_dedup.without_repeats(docs, split_from).collect()
    got = sorted(((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in found), key=repr)
    assert got == brute(ROWS)
    assert any(len(x[2]) == 2 for x in got) and any(x[2] == ((0, x[1]),) for x in got)
    assert suffix_dedup.without_repeats(docs.limit(0), split_from).count() == 0


def test_query_columns(spark):
    types = queries()["op2_suffix_dedup"](spark, "/root/testdata/sf0.001").dtypes
    assert types == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
