"""Decontamination against brute force, with a benchmark that is sent to the tasks and with one that is joined."""

from __future__ import annotations

import math
import random
import re

import pytest

from tidegate.llm import decontaminate
from tests.llm.test_fixtures import SCHEMA, got

WORDS = [f"w{k}" for k in range(40)]
CHINESE = "今天的天气非常好我们一起去公园散步吧"


def brute_tokens(text: str) -> list[str]:
    return re.findall(r"[\u2e80-\u9fff\u0e00-\u0eff]|[^\W_\u2e80-\u9fff\u0e00-\u0eff]+", text.lower())


def brute(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """(doc_id, item_id, overlap, matched, first): every item laid at every place, of several the longest."""
    best: dict[tuple, tuple] = {}
    for d, text, *_ in docs:
        t = brute_tokens(text or "")
        for i, item in items:
            w = brute_tokens(item or "")
            n = min(16, len(w))
            need = math.ceil(0.8 * n - 1e-9)
            if not w or len(w) < 5 and sum(len(x.encode()) for x in w) < 24 and len(t) != len(w):
                continue
            for shift in range(-len(w) + 1, len(t)):
                same = [0 <= shift + k < len(t) and t[shift + k] == w[k] for k in range(len(w))]
                covered = [False] * len(w)
                for k in range(len(w) - n + 1):
                    if sum(same[k : k + n]) >= need:
                        covered[k : k + n] = [True] * n
                covered = [c and 0 <= shift + k < len(t) for k, c in enumerate(covered)]
                if any(covered):
                    found = (sum(covered), sum(c and s for c, s in zip(covered, same, strict=True)), shift)
                    best[d, i] = max(best.get((d, i), found), found)
    return sorted(((d, i, *f) for (d, i), f in best.items()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(21)
    fill = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(k, " ".join(fill(rng.choice([1, 2, 3, 4, 5, 7, 9, 15, 16, 17, 30])))) for k in range(40)]
    items += [(50, CHINESE), (51, "extraordinarily incomprehensible nonetheless"), (52, "the of"), (53, "..."), (54, ""), (55, None), (None, "a null id has this item of eight words"), (0, items[0][1]), (0, "another text under one id that is in a document")]
    rows = []
    for k in range(60):
        words = fill(rng.randint(0, 25))
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items[:40])[1]).split()
            for j in range(len(own)):
                if rng.random() < 0.12:
                    own[j] = "zz"
            at = rng.randint(0, len(words))
            words[at:at] = own[rng.choice([0, 0, 2]) :]
        rows.append((k, " ".join(words)))
    rows += [(70, "甲" + CHINESE[:-1] + "乙。"), (71, "So it is extraordinarily, incomprehensible; nonetheless."), (72, "The of!"), (73, "of the of the"), (74, None), (75, ""), (None, "x A null ID has this item of eight words y"), (1, "another text under one id that is in a document"), (76, items[0][1]), (76, items[0][1]), (77, "long " * 30_000 + max(items[:40], key=lambda i: len(i[1]))[1])]
    return [(d, t, "a", "k", 0) for d, t in rows], items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_TEXT, 100])
def test_against_brute_force(spark, tables, block):
    rows, items = tables
    docs, bench = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string").repartition(2)
    found = decontaminate.contaminated(docs, bench, block).select("doc_id", "item_id", "overlap_tokens", "matched_tokens", "first_token")
    short = [r for r in rows if len(r[1] or "") < 10_000]
    want = brute(short, items)
    assert [r for r in got(found) if r[0] != 77] == want and {r[1] for r in want} >= {50, 51, 52, None}
    assert {r[1] for r in got(found) if r[0] == 77} >= {max(items[:40], key=lambda i: len(i[1]))[0]}
    dirty = {repr((d, t)) for d, t, *_ in short if any(brute([(0, t)], [i]) for i in items)}
    left = decontaminate.drop_contaminated(docs, bench, block)
    assert left.columns == docs.columns
    assert sorted(repr((r["doc_id"], r["text"])) for r in left.collect() if r["doc_id"] != 77) == sorted(repr((d, t)) for d, t, *_ in short if repr((d, t)) not in dirty)


def test_empty_tables(spark, tables):
    docs, bench = spark.createDataFrame(tables[0], SCHEMA), spark.createDataFrame(tables[1], "item_id long, text string")
    for block in (decontaminate.BLOCK_TEXT, -1):
        assert decontaminate.contaminated(docs.limit(0), bench, block).count() == decontaminate.contaminated(docs, bench.limit(0), block).count() == 0
        assert decontaminate.drop_contaminated(docs, bench.limit(0), block).count() == docs.count()
