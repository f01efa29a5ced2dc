"""The pipeline's stages, each against brute force on what the stage before kept."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tests.llm.test_fixtures import brute_near_groups
from tidegate.llm.pieces import Vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, from the documents on."""
    out = [("documents", spark.read.parquet(f"{SF}/documents.parquet"))]
    for name, stage in corpus_pipeline.STAGES:
        before = spark.createDataFrame(out[-1][1].collect(), out[-1][1].schema)
        out.append((name, stage(spark, before, SF)))
    return {name: (df.columns, [r.asDict() for r in df.collect()]) for name, df in out}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_near_dedup", "decontamination", "pieces"]
    columns = stages["documents"][0]
    assert all(stages[n][0] == columns for n, _ in corpus_pipeline.STAGES[:-1])


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["quality"][1]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and len(kept) < len(stages["documents"][1])


def test_dedup_stages(stages):
    rows = sorted(stages["quality"][1], key=lambda r: r["doc_id"])
    first = {}
    for r in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r)
    assert sorted(r["doc_id"] for r in stages["exact_dedup"][1]) == sorted(r["doc_id"] for r in first.values())
    left = sorted(stages["exact_dedup"][1], key=lambda r: r["doc_id"])
    label = brute_near_groups([r["text"] for r in left])
    first = {}
    for r, k in zip(left, label, strict=True):
        first.setdefault(k, r["doc_id"])
    assert sorted(r["doc_id"] for r in stages["simhash_near_dedup"][1]) == sorted(first.values())


def test_leaks_go_and_others_stay(spark, stages):
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = tokens(r["text"])
        grams |= {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    rows = stages["simhash_near_dedup"][1]
    leaked = {r["doc_id"] for r in rows if any(tuple(tokens(r["text"])[k : k + 13]) in grams for k in range(len(tokens(r["text"])) - 12))}
    assert leaked == {r["doc_id"] for r in rows} - {r["doc_id"] for r in stages["decontamination"][1]}


def test_pieces_give_the_texts_back(stages):
    v = Vocabulary.load()
    texts = {r["doc_id"]: r["text"] for r in stages["decontamination"][1]}
    rows = stages["pieces"][1]
    assert len(rows) == len(texts) and all(r["round_trip"] and v.decode(r["piece_ids"]) == texts[r["doc_id"]] for r in rows)


@pytest.fixture(scope="module")
def odd(spark, stages):
    """Documents with nulls in every column, empty and very long texts, repeated rows and ids, and columns of clashing names."""
    rows = [stages["documents"][1][k] for k in range(40)]
    text = max((r["text"] for r in rows), key=len)
    rows = [(r["doc_id"], r["text"], r["lang"], "x", 1, "y") for r in rows]
    rows += [rows[0], rows[0], (rows[1][0], text, None, None, None, None), (None, text, "en", "x", 2, "y"), (None, None, None, None, None, None), (900001, "", "en", "x", 3, "y"), (900002, None, "en", "x", 4, "y"), (900003, "  \n", "en", "x", 5, "y"), (900004, text * 40, "en", "x", 6, "y"), (None, text, "en", "x", 2, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, sid string, key int, stop string").repartition(3)


def test_stages_on_odd_rows(spark, odd):
    """Every stage keeps the columns and returns rows of its input, each at most as often as it came."""
    from collections import Counter

    for name, stage in corpus_pipeline.STAGES:
        before, found = Counter(map(tuple, odd.collect())), stage(spark, odd, SF)
        if name == "pieces":
            assert found.count() == sum(before.values()) and found.where("round_trip").count() == sum(before.values())
            continue
        after = Counter(map(tuple, found.collect()))
        assert found.columns == odd.columns and not after - before
        texts = lambda rows: {r[1] or "" for r in rows}
        if name == "exact_dedup":
            normal = Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in after.elements())
            assert set(normal.values()) == {1} and texts(before) >= texts(after) and len(normal) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t) for t in texts(before)})
        if name == "simhash_near_dedup":
            assert {r[0] for r in after if not (r[1] or "").split()} == {900001}
            assert sum(after.values()) == len(set(brute_near_groups([r[1] or "" for r in before.elements()])))


def test_stages_on_an_empty_table(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd.limit(0), SF)
        assert found.count() == 0 and (name == "pieces" or found.columns == odd.columns)


def test_run_equals_the_stages_in_a_row(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in found.select("doc_id").collect()) == sorted(r["doc_id"] for r in stages["pieces"][1])
