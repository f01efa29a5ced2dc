"""Every operator against brute force on small tables with nulls, empty, long, repeated and clashing input."""

from __future__ import annotations

import datetime
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, exact_dedup, html_text, near_dedup, pieces, pseudonyms, quality, sharding, simhash, suffix_dedup, toxicity
from tidegate.llm.common import column_bytes, row_blocks
from tidegate.llm.components import connected_components

WORDS = "the of and to in that is was for with on as by at from this be are or an river stone market letter winter garden engine paper method signal theory window bridge".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[tuple]:
    """(doc_id, text, source, key, start): clashing column names on purpose."""
    rng = random.Random(7)
    long = prose(rng, 9000)
    base = prose(rng, 300)
    near = base.split()
    near[40], near[200] = "changed", "words"
    shared = prose(rng, 120)
    rows = [
        (1, base, "a"), (2, base, "b"), (3, base.replace(" ", " \t\n", 7), "a"), (4, " ".join(near), None), (5, None, "a"), (6, "", "a"), (7, "  ", "c"),
        (8, long, "a"), (9, prose(rng, 30) + shared + prose(rng, 20), "b"), (10, prose(rng, 5) + shared + prose(rng, 50), "b"), (11, "one", "a"), (12, "one", "a"), (12, "one", "a"),
        (None, base, "a"), (None, None, None), (13, "ab " * 900, "z"), (14, "é中 ▁ " * 40 + "\n\tx", "z"), (15, "x" * 399, "z"), (16, "y" * 400, "z"), (12, "other text under one id", "a"),
    ]
    rows += [(100 + k, prose(rng, rng.randint(1, 80)), rng.choice("ab")) for k in range(40)]
    return [(d, t, s, "clash", 1) for d, t, s in rows]


SCHEMA = "doc_id long, text string, source string, key string, start int"


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def test_exact_groups(docs, none, texts):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in texts]
    want = []
    for (d, *_), n in zip(texts, normal, strict=True):
        ids = [x[0] for x, m in zip(texts, normal, strict=True) if m == n]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((d, keep, len(ids), d == keep, hashlib.sha256(n.encode()).hexdigest()))
    assert got(exact_dedup.exact_groups(docs)) == sorted(want, key=repr)
    assert exact_dedup.exact_groups(none).count() == 0
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(normal))


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3 * exact_dedup.CHUNK + 11, dtype=np.uint8)
    whole = tuple(int(x) for x in exact_dedup.fingerprints(data, np.array([0, len(data)]))[0])
    slow = tuple(sum((int(b) + 1) * pow(base, i, p) for i, b in enumerate(data.tolist())) % p for p, base in exact_dedup.FIELDS[:1])
    assert whole[:1] == slow
    for cut in (0, 1, exact_dedup.CHUNK, len(data) - 3):
        a, b = (tuple(int(x) for x in exact_dedup.fingerprints(part, np.array([0, len(part)]))[0]) for part in (data[:cut], data[cut:]))
        assert exact_dedup.combine(a, cut, b) == whole


def test_collisions_are_split(docs, texts, monkeypatch):
    """With every fingerprint alike, only the comparison of chunks tells texts apart."""
    equal = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") == 3)

    def same(data, offs):
        return np.zeros((len(offs) - 1, 4), np.int64)

    monkeypatch.setattr(exact_dedup, "fingerprints", same)
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "one"}, {"doc_id": 2, "text": "two"}])
    fp = [b.to_pylist() for b in exact_dedup._fingerprint_batches(iter([batch]))][0]
    chunks = [b.to_pylist() for b in exact_dedup._chunk_batches(iter([batch]))][0]
    assert len({(r["fp_a"], r["fp_b"], r["n_bytes"]) for r in fp}) == 1 and len({c["bytes"] for c in chunks}) == 2
    assert equal.count() == 3


def brute_fingerprint(text: str) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    sh = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, none, texts):
    fp = [brute_fingerprint(t or "") for _, t, *_ in texts]
    label = list(range(len(fp)))
    for a, b in itertools.combinations(range(len(fp)), 2):
        if (fp[a] ^ fp[b]).bit_count() <= 3 and label[a] != label[b]:
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    least = {k: min((texts[i][0] for i in range(len(fp)) if label[i] == k and texts[i][0] is not None), default=None) for k in set(label)}
    want = sorted(((texts[i][0], f"{fp[i]:016x}", least[label[i]]) for i in range(len(fp))), key=repr)
    assert got(simhash.simhash_components(docs)) == want
    assert simhash.simhash_components(none).count() == 0


def brute_near_groups(texts: list[str]) -> list[int]:
    """A group number per text: Jaccard similarity of 0.8 or more of the five-word shingle sets, over any number of links; no words are like no words."""
    sets = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if label[a] != label[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    return label


def test_near_dedup_keeps_one_of_each_group(docs, none, texts):
    label = brute_near_groups([t or "" for _, t, *_ in texts])
    want = {k: min((texts[i][0] for i in range(len(texts)) if label[i] == k and texts[i][0] is not None), default=None) for k in set(label)}
    kept = near_dedup.near_dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len(want)
    assert {(r["doc_id"], label[[(d, t) for d, t, *_ in texts].index((r["doc_id"], r["text"]))]) for r in rows} == {(d, k) for k, d in want.items()}
    assert near_dedup.near_dedup(none).count() == 0 and near_dedup.near_dedup(none).columns == none.columns


def test_similar_texts_link_from_four_fifths_on(spark):
    """Copies with changed words: those of similarity 0.87 and more go, those under 0.7 stay."""
    rng = random.Random(11)
    shingle_set = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    rows, gone, stay = [], set(), set()
    for n in range(60):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(150, 900)))
        words = base.split()
        for k in rng.sample(range(len(words)), max(1, int(len(words) * rng.choice([0.002, 0.008, 0.05, 0.1])))):
            words[k] = "altered"
        rows += [(2 * n, base), (2 * n + 1, " ".join(words))]
        a, b = map(shingle_set, (rows[-2][1], rows[-1][1]))
        s = len(a & b) / len(a | b)
        if s >= 0.87:
            gone.add(2 * n + 1)
        elif s < 0.7:
            stay.add(2 * n + 1)
    kept = {r["doc_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert gone and stay and not gone & kept and stay <= kept and {2 * n for n in range(60)} <= kept


def test_band_links_connect_a_chain_and_split_batches():
    rng = np.random.default_rng(5)
    wide = np.tile(rng.integers(0, 2**63, 8, dtype=np.uint64), (40, 1))
    for k in range(1, 40):
        bits = rng.choice(512, 60, replace=False)
        wide[k] = wide[k - 1]
        for b in bits:
            wide[k, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    left, right = near_dedup.band_links(wide)
    assert len(left) == 39 and len(set(right)) == 39
    batch = pa.RecordBatch.from_arrays([pa.array([7] * 40 + [9] * 2, pa.int64()), pa.array(range(42), pa.int64()), pa.array([x.tobytes() for x in [*wide, wide[0], ~wide[0]]], pa.binary())], names=["key", "fp", "wide"])
    whole, parts = (sorted(tuple(r.values()) for b in near_dedup._link_batches(iter(batches)) for r in b.to_pylist()) for batches in ([batch], [batch.slice(k, 5) for k in range(0, 42, 5)]))
    assert whole == parts and len(whole) == 39


def test_pigeonring_keys_lose_no_pair():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    b = a.copy()
    for k in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    ka, kb = simhash.ring_keys(a), simhash.ring_keys(b)
    meet = ka == kb
    ok = np.array([simhash.within_budget(a, b, k // 3) for k in range(24)])
    assert (meet & ok).any(axis=0).all()
    far = a ^ rng.integers(0, 2**63, 3000, dtype=np.uint64)
    assert (simhash.ring_keys(far) == ka).any(axis=0).mean() < 0.01


def test_large_buckets_connect_like_small_ones(monkeypatch):
    rng = np.random.default_rng(3)
    code = 4
    equal = {(code // 3 + k) % 8 for k in simhash.CHOICES[code % 3]}
    free = [k for k in range(64) if k // 8 not in equal]
    fp = np.unique(np.array([sum(1 << free[b] for b in rng.choice(len(free), 4, replace=False)) for _ in range(300)], np.uint64))

    def groups(links):
        parent = {int(x): int(x) for x in fp}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in zip(*links, strict=True):
            parent[top(int(u))] = top(int(v))
        found = {}
        for x in fp.tolist():
            found.setdefault(top(x), set()).add(x)
        return sorted(map(sorted, found.values()))

    def whole(values):
        """Pairs that keep the budgets of this key's chain; others within 3 bits meet under another key."""
        a, b = (np.array(x, np.uint64) for x in zip(*itertools.combinations(values.tolist(), 2), strict=True))
        ok = simhash.within_budget(a, b, code // 3) & (np.bitwise_count(a ^ b) <= 3)
        return a[ok], b[ok]

    assert groups(simhash.bucket_links(fp, code)) == groups(whole(fp))
    monkeypatch.setattr(simhash, "LOOKUP_FROM", 2)
    assert groups(simhash.bucket_links(fp, code)) == groups(whole(fp))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7), (None, 3)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {k: 100 for k in range(100, 161)} | {k: 5 for k in range(5, 40)}


def brute_repeats(texts, length=400):
    raw = [(t or "").encode() for _, t, *_ in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for k in range(len(b) - length + 1):
            seen[b[k : k + length]] = seen.get(b[k : k + length], 0) + 1
    out = []
    for (d, *_), b in zip(texts, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        gone = gone[:-1]
        out.append((d, len(b), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split_from", [suffix_dedup.SPLIT_FROM, 3, 2])
def test_repeats(docs, none, texts, split_from):
    assert got(suffix_dedup.remove_repeats(docs, split_from)) == brute_repeats(texts)
    assert suffix_dedup.remove_repeats(none, split_from).count() == 0


def test_run_length_index():
    rng = random.Random(5)
    parts = ["".join(rng.choice("ab") for _ in range(40)) for _ in range(4)]
    docs = ["".join(rng.choice(parts) for _ in range(3)).encode() + b"q" * k for k in range(6)] + [b"", b"a", b"\x00\xff"]
    index = suffix_dedup.RunLengthIndex(docs)
    stat = index.matching_statistics()
    suffixes = [d[k:] for d in docs for k in range(len(d))]
    at = [int(index.base[i]) + k for i, d in enumerate(docs) for k in range(len(d))]

    def common(x, y):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n

    for i, (s, p) in enumerate(zip(suffixes, at, strict=True)):
        assert stat[p] == max((common(s, t) for j, t in enumerate(suffixes) if j != i), default=0)
    assert len(index.run_starts) < index.n


def test_masks_are_lossless():
    for gone in itertools.combinations(range(decontaminate.WINDOW), 3):
        assert any(not {s + p for p in mask} & set(gone) for mask in decontaminate.MASKS for s in range(decontaminate.WINDOW - mask[-1]))


def test_contamination(spark, docs, none):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(500)]
    item = [rng.choice(vocabulary) for _ in range(30)]
    short = [rng.choice(vocabulary) for _ in range(7)]
    bench = spark.createDataFrame([(1, " ".join(item), "x"), (2, " ".join(short), "x"), (3, "the of", "x"), (4, None, "x"), (None, "a b c d e f g", "x"), (5, "", "x")], "item_id long, text string, doc_id string")
    hit = list(item)
    for k in (4, 9, 15):
        hit[k] = "zz"
    fill = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = [(1, fill(50) + item + fill(9)), (2, fill(3) + hit + fill(40)), (3, fill(20) + item[7:23] + fill(2)), (4, fill(20) + item[:12] + fill(20)), (5, [w.upper() + "," for w in item]), (6, fill(200)), (7, fill(4) + short + fill(4)), (8, fill(4) + short[:3] + ["zz"] + short[4:]), (9, fill(4) + short[:4])]
    rows = [(d, " ".join(t), "a", "k", 0) for d, t in rows] + [(None, " ".join(item), "a", "k", 0), (10, None, None, None, None), (1, "w1 w2", "a", "k", 0)]
    mine = spark.createDataFrame(rows, SCHEMA)
    found = {(r["doc_id"], r["item_id"]): r["matched_tokens"] for r in decontaminate.contaminated(mine, bench).collect()}
    assert found == {(1, 1): 30, (2, 1): 27, (3, 1): 16, (5, 1): 30, (7, 2): 7, (8, 2): 6, (None, 1): 30}
    left = decontaminate.drop_contaminated(mine, bench)
    assert left.columns == mine.columns and sorted((r["doc_id"], r["text"] is None) for r in left.collect()) == [(1, False), (4, False), (6, False), (9, False), (10, True)]
    assert decontaminate.contaminated(none, bench).count() == decontaminate.contaminated(mine, bench.limit(0)).count() == 0


def test_shards(docs, none, texts):
    found = sharding.interleaved_shards(docs, bucket_rows=10).collect()
    by = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r)
    n = len(texts)
    assert len(found) == n and {len(v) for v in by.values()} <= {n // 24, -(-n // 24)}
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in texts), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == want
    # Any prefix of the order holds each source in proportion.
    order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    for source in {r["source"] for r in found}:
        all_of = sum(r["source"] == source for r in found)
        for k in range(1, n + 1):
            assert abs(sum(r["source"] == source for r in order[:k]) - all_of * k / n) <= len({r["source"] for r in found})
    key = lambda rows: sorted((repr(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in rows if r["doc_id"] not in (None, 12))
    assert key(found) == key(sharding.interleaved_shards(docs.repartition(7), bucket_rows=1000).collect())
    assert sharding.interleaved_shards(none).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    words = ["▁", "▁t", "▁th", "▁the", "h", "e", "t", "a", "c", "at", "▁cat", "▁ca", "the", "he", "▁▁", "o", "r"]
    rows = [("<unk>", 0.0, "none"), ("<s>", 0.0, "none")] + [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]
    return pieces.Vocabulary.of(rows + [(w, -1.5 * (k % 7) - 1 - len(w) % 3, "piece") for k, w in enumerate(words)])


def all_segmentations(v, text):
    edges, found = v.edges(text), [[(0.0, ())]]
    for end in range(1, len(text) + 1):
        found.append([(s + score, p + ids) for start, ids, score in edges[end] for s, p in found[start]])
    return sorted(found[-1], key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["the cat", "thecat  the", "é the\ncat", "▁a", " ", "catcatcat", "q"])
def test_n_best_against_all_segmentations(vocabulary, text):
    want = all_segmentations(vocabulary, " " + text)
    found = pieces.Encoder(vocabulary, 5).encode(text)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in want[:5]])
    assert len({tuple(i) for _, i in found}) == len(found)
    for score, ids in found:
        assert vocabulary.decode(ids) == text and any(p == tuple(ids) and s == pytest.approx(score) for s, p in want)


def test_pieces_of_documents(docs, none, texts, vocabulary):
    found = pieces.encoded(docs, vocabulary, 3).persist()
    assert found.count() == len(texts) and found.where("round_trip").count() == len(texts)
    back = got(pieces.decoded(found, vocabulary))
    assert back == sorted(((d, t or "") for d, t, *_ in texts), key=repr)
    row = found.where("doc_id = 11").first()
    encoder = pieces.Encoder(vocabulary, 3)
    best = encoder.encode("one")
    assert row["piece_ids"] == best[0][1] and row["nbest_scores"] == [s for s, _ in best] and row["nbest_pieces"] == [len(i) for _, i in best]
    assert pieces.encoded(none, vocabulary).count() == 0
    long = "catthe" * 40  # a link that is searched by itself
    assert encoder.encode(long)[0][0] == pytest.approx(vocabulary.n_best(" " + long, 1)[0][0])


def test_public_vocabulary():
    v = pieces.Vocabulary.load()
    found = pieces.Encoder(v, 3).encode("The quick brown fox, 42 times.\n")
    assert v.decode(found[0][1]) == "The quick brown fox, 42 times.\n" and found[0][0] >= found[1][0] >= found[2][0]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation(size):
    assert sorted(pseudonyms.permute(k, size, b"k", "t") for k in range(size)) == list(range(size))


def test_pseudonyms_keep_formats():
    key = b"secret"
    text = 'card 4111 1111 1111 1111, 4111111111111112; +1 (212) 555-0147 and 415-555-2671; 10.0.0.255 300.1.1.1; 2024-02-29 29.02.2024 2023-02-29; a.b1@x.org; 123-45-6789 000-45-6789; GB82 WEST 1234 5698 7654 32; token = "0123456789abcdef01"; 12345'
    new, counts = pseudonyms.pseudonymise(text, key)
    assert counts == {"card": 1, "phone": 2, "ip": 1, "date": 2, "email": 1, "ssn": 1, "iban": 1, "secret": 1}
    assert re.sub(r"\d", "0", re.sub(r"10\.0\.0\.255|\d+\.\d+\.\d+\.\d+", "ip", new)).count("0000 0000 0000 0000") == 1
    card = re.search(r"card ([\d ]{19}),", new)[1]
    assert pseudonyms.luhn(card.replace(" ", "")) and card != "4111 1111 1111 1111"
    for kept in ("4111111111111112", "300.1.1.1", "2023-02-29", "000-45-6789", "; 12345", "@x.org", "+1 ("):
        assert kept in new
    iso, dotted = re.search(r"; (\d{4}-\d\d-\d\d) (\d\d\.\d\d\.\d{4}) ", new).groups()
    assert datetime.date.fromisoformat(iso) == datetime.datetime.strptime(dotted, "%d.%m.%Y").date()
    iban = re.search(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", new)[0].replace(" ", "")
    assert pseudonyms._mod97(iban) == 1
    assert pseudonyms.pseudonymise("see a.b1@x.org", key)[0].split()[1] in new
    assert pseudonyms.pseudonymise(text, b"other")[0] != new and pseudonyms.pseudonymise("no values 7", key) == ("no values 7", {})


def test_pseudonyms_of_documents(spark, docs, none, texts):
    found = got(pseudonyms.pseudonymised(docs, b"k").select("doc_id", "text", "n_replaced"))
    assert found == sorted(((d, t, 0) for d, t, *_ in texts), key=repr)
    assert pseudonyms.pseudonymised(none, b"k").count() == 0


def test_quality_network():
    rng = random.Random(1)
    good = [prose(rng, rng.randint(3, 200)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, rng.randint(3, 200)).split()) for _ in range(75)] + [prose(rng, 60).replace(" ", " | ") for _ in range(75)]
    model = quality.train(good[:100] + bad[:50] + bad[75:125], [1] * 100 + [0] * 100, steps=150)
    data, offs = column_bytes(pa.array(good[100:] + bad[50:75] + bad[125:] + ["", None]))
    s = np.concatenate([quality.scores(model, p, c) for _, _, p, c in row_blocks(data, offs, 5000)])
    assert (s[:50] >= quality.THRESHOLD).mean() > 0.95 and (s[50:100] < quality.THRESHOLD).mean() > 0.95 and len(s) == 102
    whole = np.concatenate([quality.chunk_table(np.frombuffer(good[0].encode(), np.uint8), np.array([0, len(good[0].encode())]))[0]])
    assert len(whole) == len(quality.chunk_starts(len(good[0].encode())))
    assert 0 < quality.scores(quality.train(["a"], [1]), data, offs)[0] < 1 and quality.scores(quality.train([], []), data, offs)[0] == pytest.approx(0.5)


def test_quality_gradients():
    rng = np.random.default_rng(0)
    model = quality.train([], [])
    model = {k: rng.normal(0, 0.3, v.shape) for k, v in model.items()}
    chunks, row = rng.integers(0, 256, (5, quality.CHUNK)).astype(np.uint8), np.array([0, 0, 1, 2, 2])
    y, w = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss(m):
        z = quality._combine(m, quality._pool(m, chunks), row, 3)[3]
        return float((w * (np.logaddexp(0, z) - y * z)).sum() / 3)

    grads = quality._gradients(model, chunks, row, y, w)
    for name, g in grads.items():
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = ({n: v.copy() for n, v in model.items()} for _ in range(2))
        up[name][k] += 1e-5
        down[name][k] -= 1e-5
        assert g[k] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=0.02)


def test_toxicity_model():
    rng = random.Random(2)
    clean = [prose(rng, rng.randint(5, 150)) for _ in range(240)]

    def spoil(t, word):
        w = t.split()
        w.insert(rng.randrange(len(w)), word)
        return " ".join(w)

    toxic = [spoil(prose(rng, rng.randint(5, 150)), rng.choice(["idiot", "moron", "worthless"])) for _ in range(120)]
    model = toxicity.train(clean[:160] + toxic[:90], [0] * 160 + [1] * 90, steps=300)
    score = lambda ts: toxicity.scores(model, *column_bytes(pa.array(ts)))
    assert (score(clean[160:]) < 0.5).mean() > 0.95 and (score(toxic[90:]) >= 0.5).mean() > 0.95
    assert score([prose(rng, 3000) + " you idiot " + prose(rng, 3000)])[0] > 0.5
    assert score(["such a worthles thing", "IDIOT", "", None]).tolist()[:2] > [0.5, 0.5] and len(score(["", None])) == 2


def test_scores_of_documents(spark, docs, none, texts):
    rows = []
    for d, t, *_ in texts:
        if d is not None and t:
            rows.append((d, d % 2, (d // 2) % 2, "x"))
    labels = spark.createDataFrame(rows + [(None, 1, 1, "x"), (99999, None, 1, "x")], "doc_id long, quality int, toxic int, text string")
    for found in (quality.score_quality(docs, quality.train([], [])), toxicity.score_toxicity(docs, toxicity.fit(docs, labels))):
        out = found.collect()
        assert len(out) == len(texts) and all(0 <= r["score"] <= 1 for r in out)
        assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert quality.keep_quality(docs, quality.train(["x"], [1])).columns == docs.columns
    assert quality.score_quality(none, quality.fit(none, labels)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<header><div class="logo">The Site</div></header><!-- x --><div class="ad">Buy now, all of it.</div><article><h1>A  title &amp; more</h1><p>First <b>bold</b>&nbsp;text.<br>goes on<p>Second text with 1 &lt; 2.</p><ul><li>One item here.</li></ul>
<form><label>Name</label><input></form></article><aside class="sidebar"><h3>Related</h3><ul><li><a href="x">Link</a></li></ul></aside><div id="comments"><div class="comment"><p>I disagree with that.</p></div></div><footer>&copy; The Site.</footer>"""


@pytest.fixture(scope="module")
def labeller():
    return html_text.train()


def test_main_text(labeller):
    assert html_text.extract([PAGE, "", "<p>", "<<<>"], labeller)[0] == "A title & more\n\nFirst bold text. goes on\n\nSecond text with 1 < 2.\n\nOne item here."
    pages, labels = html_text.made_up_pages(120, 12345)
    right = np.concatenate([a == b for a, b in zip(html_text.label(pages, labeller), labels, strict=True)])
    assert right.mean() > 0.97


def test_labeller_gradients():
    pages, labels = html_text.made_up_pages(3, 5)
    rng = np.random.default_rng(1)
    model = {k: (v + rng.normal(0, 0.05, v.shape)).astype(np.float64) for k, v in html_text.train(20, 1).items()}

    def loss(m):
        z = html_text._forward(html_text.features(pages, m).astype(np.float64), np.array([len(p) for p in pages]), m)[0]
        return float((np.logaddexp(0, z) - np.concatenate(labels) * z).sum() / len(pages))

    grads = html_text._gradients(pages, np.concatenate(labels), model)
    for name, g in grads.items():
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = ({n: v.copy() for n, v in model.items()} for _ in range(2))
        up[name][k] += 1e-2
        down[name][k] -= 1e-2
        assert g[k] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.05)


def test_pages(spark, labeller):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    found = got(html_text.main_texts(pages, labeller).select("page_id", "url", "n_chars"))
    n = len(html_text.extract([PAGE], labeller)[0])
    assert found == sorted([(1, "u", n), (2, None, 0), (None, "v", 0), (1, "u", n)], key=repr)
    assert html_text.main_texts(pages.limit(0), labeller).count() == 0
