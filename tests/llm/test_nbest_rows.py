"""All N segmentations of every document can be read from the operator's rows."""

from __future__ import annotations

from tests.llm.test_fixtures import all_segmentations, docs, none, texts, vocabulary  # noqa: F401
from tidegate.llm import pieces


def test_rows_have_the_ids_of_all_n(docs, texts, vocabulary):  # noqa: F811
    rows = pieces.encoded(docs, vocabulary, 3).collect()
    encoder = pieces.Encoder(vocabulary, 3)
    found = sorted((repr((r["doc_id"], vocabulary.decode(r["piece_ids"]))), r["nbest_ids"], r["nbest_scores"], r["nbest_pieces"]) for r in rows)
    want = sorted((repr((d, t or "")), [i for _, i in e], [s for s, _ in e], [len(i) for _, i in e]) for d, t, e in ((d, t, encoder.encode(t or "")) for d, t, *_ in texts))
    assert [(a, b, d) for a, b, _, d in found] == [(a, b, d) for a, b, _, d in want]
    for r in rows:
        assert r["round_trip"] and r["nbest_ids"][0] == r["piece_ids"] and len({tuple(i) for i in r["nbest_ids"]}) == len(r["nbest_ids"])
        assert {vocabulary.decode(i) for i in r["nbest_ids"]} == {vocabulary.decode(r["piece_ids"])}
    assert any(len(r["nbest_ids"]) == 3 for r in rows)


def test_rows_match_all_segmentations(spark, vocabulary):  # noqa: F811
    text = "thecat  the"
    row = pieces.encoded(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary, 3).first()
    score = {p: s for s, p in all_segmentations(vocabulary, " " + text)}
    assert len(row["nbest_ids"]) == 3
    assert all(abs(score[tuple(i)] - s) < 1e-9 for i, s in zip(row["nbest_ids"], row["nbest_scores"], strict=True))


def test_a_wrong_alternative_is_seen(monkeypatch, vocabulary):  # noqa: F811
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["the cat"]})
    monkeypatch.setattr(pieces, "changed", lambda ids, changes: ids[:-1] if changes else ids)
    out = next(pieces._encode_batches(iter([batch]), vocabulary, 3)).to_pylist()[0]
    assert len(out["nbest_ids"]) == 3 and not out["round_trip"]


def test_links_and_pieces_that_share_a_hash_are_told_apart(monkeypatch, vocabulary, texts):  # noqa: F811
    """With a hash of 8 values, only bytes tell links and pieces apart."""
    some = [t for _, t, *_ in texts if t and len(t) < 300][:12] + ["the cat", "thecat  the", "é the\ncat"]
    want = [pieces.Encoder(vocabulary, 3).encode(t) for t in some]
    real = pieces.range_hash
    monkeypatch.setattr(pieces, "range_hash", lambda p, s, e: real(p, s, e) & pieces.U64(7))
    import numpy as np

    data = np.frombuffer(b"abcabdabcx", np.uint8)
    begin, end = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 10])
    first, which = pieces.split_collisions(data, begin, end, np.array([0]), np.zeros(4, int))
    assert [data[begin[k] : end[k]].tobytes() for k in first[which]] == [b"abc", b"abd", b"abc", b"x"]
    monkeypatch.undo()
    monkeypatch.setattr(pieces, "range_hash", lambda p, s, e: np.where(e - s > 12, real(p, s, e) & pieces.U64(7), real(p, s, e)))
    assert [pieces.Encoder(vocabulary, 3).encode(t) for t in some] == want


def test_long_links_against_all_segmentations(vocabulary):  # noqa: F811
    """A link over LONG bytes is searched by itself; the n best are those of one search over the whole lattice."""
    for text in ("catthe" * 12, "thecat  the" + "hecat" * 14 + " q the"):
        found = pieces.Encoder(vocabulary, 3).encode(text)
        whole = vocabulary.n_best(" " + text, 3)
        assert [round(s, 6) for s, _ in found] == [round(s, 6) for s, _ in whole] and all(vocabulary.decode(i) == text for _, i in found)


def test_remembered_links_change_nothing(monkeypatch, vocabulary, texts):  # noqa: F811
    """The same answers from a new encoder for each text, from one that remembers, and from one that often forgets."""
    some = [t for _, t, *_ in texts if t]
    want = [pieces.Encoder(vocabulary, 3).encode(t) for t in some]
    one = pieces.Encoder(vocabulary, 3)
    assert [one.encode(t) for t in some] == [one.encode(t) for t in some] == want and len(one.seen["key"]) == len(one.seen["slot"]) == len(one.seen["size"]) > 20
    assert (one.seen["key"][1:] > one.seen["key"][:-1]).all()
    monkeypatch.setattr(pieces, "CACHE_LINKS", 7)
    forgetful = pieces.Encoder(vocabulary, 3)
    assert [forgetful.encode(t) for t in some] == want and len(forgetful.seen["key"]) <= 7
