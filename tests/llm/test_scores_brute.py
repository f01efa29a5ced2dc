"""Scores of op8 and op9 against plain loops over bytes, words and n-grams, and pseudonyms of a table with personal data."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_fixtures import prose
from tidegate.llm import pseudonyms, quality, toxicity
from tidegate.llm.common import column_bytes, row_blocks


@pytest.fixture(scope="module")
def some():
    rng = random.Random(3)
    return [prose(rng, n) for n in (1, 3, 16, 17, 60, 200)] + ["", "  ", "é中 x" * 90, "word " * 70]


def test_quality_scores(some):
    rng = np.random.default_rng(4)
    model = {k: rng.normal(0, 0.4, v.shape) for k, v in quality.train([], []).items()}

    def slow(text: str) -> float:
        raw, pooled = text.encode(), []
        for a in quality.chunk_starts(len(raw)):
            chunk = raw[a : a + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            answers = []
            for at in range(0, quality.CHUNK - quality.FILTER + 1, quality.STRIDE):
                window = np.concatenate([model["E"][b] for b in chunk[at : at + quality.FILTER]])
                answers.append(np.maximum(window @ model["W"] + model["b"], 0))
            pooled.append(np.concatenate([np.max(answers, axis=0), np.mean(answers, axis=0)]))
        hidden = np.tanh(np.array(pooled) @ model["H"] + model["c"])
        z = np.concatenate([hidden.mean(axis=0), hidden.max(axis=0)]) @ model["V"] + model["d"]
        return 1 / (1 + math.exp(-float(z[0])))

    for block in (100, 1 << 20):
        data, offs = column_bytes(pa.array(some))
        found = np.concatenate([quality.scores(model, p, c) for _, _, p, c in row_blocks(data, offs, block)])
        assert found.tolist() == pytest.approx([slow(t) for t in some], rel=1e-5)


def test_toxicity_scores(some):
    rng = np.random.default_rng(5)
    d = toxicity.DIM
    model = {"E": rng.normal(0, 1, (toxicity.BUCKETS, d)), "W": rng.normal(0, 1, (2 * d, 2)), "b": rng.normal(0, 1, 2)}

    def vector(word: str) -> np.ndarray:
        ids, _ = toxicity.subwords([word.encode()])
        return model["E"][ids].mean(axis=0)

    def odds(mean: np.ndarray, top: np.ndarray) -> float:
        z = np.concatenate([mean, top]) @ model["W"] + model["b"]
        return float(z[1] - z[0])

    def slow(text: str) -> float:
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
        if not words:
            return 1 / (1 + math.exp(-float(model["b"][1] - model["b"][0])))
        mean = np.mean([vector(w) for w in words], axis=0)
        cuts = [words[max(0, k) : k + toxicity.PASSAGE] for shift in (0, toxicity.PASSAGE // 2) for k in range(-shift, len(words), toxicity.PASSAGE)]
        best = max(odds(mean, sum(vector(w) for w in sorted(set(c))) / toxicity.PASSAGE) for c in cuts if c)
        return 1 / (1 + math.exp(-best))

    for block in (100, 1 << 20):
        data, offs = column_bytes(pa.array(some))
        found = np.concatenate([toxicity.scores(model, p, c) for _, _, p, c in row_blocks(data, offs, block)])
        assert found.tolist() == pytest.approx([slow(t) for t in some], rel=1e-6)


def test_toxicity_subwords():
    ids, word = toxicity.subwords([b"abcde", b"x"])
    grams = [{b"<abcde>"[a : a + n] for n in toxicity.GRAMS for a in range(8 - n)}, set()]
    assert [int((word == k).sum()) for k in (0, 1)] == [len(g) + 1 for g in grams] or [int((word == k).sum()) for k in (0, 1)] == [sum(max(0, 8 - n) for n in toxicity.GRAMS) + 1, 1]


def test_pseudonyms_of_a_table(spark):
    """Equal values get equal pseudonyms in all documents, different ones different, and everything around them stays."""
    rng = random.Random(8)
    values = {
        "card": ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005"], "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606"],
        "ssn": ["123-45-6789", "219-09-9998"], "phone": ["+1 (212) 555-0147", "415-555-2671"], "ip": ["10.0.0.255", "192.168.1.1"], "date": ["2024-02-29", "01.12.1999"], "email": ["a.b1@x.org", "someone@example.com"], "secret": ["0123456789abcdef01"],
    }
    rows, used = [], []
    for k in range(120):
        kind = rng.choice(list(values))
        value = rng.choice(values[kind])
        before, after = prose(rng, rng.randint(0, 9)), prose(rng, rng.randint(0, 9))
        rows.append((k if k % 10 else None, f"{before} {'token = ' if kind == 'secret' else ''}{value}; {after}", "clash"))
        used.append((kind, value, before, after))
    rows += [(500, None, "clash"), (501, "", "clash"), (502, "nothing 12 here", "clash"), (502, "nothing 12 here", "clash")]
    found = {r["n_replaced"]: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string, key string").limit(0), b"k").collect()}
    assert found == {}
    out = pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string, key string").coalesce(1), b"k").collect()
    assert [r["doc_id"] for r in out] == [r[0] for r in rows] and [r["text"] for r in out[120:]] == [r[1] for r in rows[120:]]
    seen: dict[tuple, str] = {}
    for r, (kind, value, before, after) in zip(out, used, strict=False):
        assert r["text"].startswith(before) and r["text"].endswith("; " + after) and r[f"n_{kind}"] == r["n_replaced"] == 1
        new = r["text"][len(before) + 1 : len(r["text"]) - len(after) - 2].removeprefix("token = ")
        assert new != value and len(new) == len(value) and [c.isdigit() for c in new] == [c.isdigit() for c in value] or kind in ("ip", "secret")
        assert seen.setdefault((kind, value), new) == new and pseudonyms.RULES[kind](new, b"k") is not None
    assert len({(k, n) for (k, _), n in seen.items()}) == len(seen)
