"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (4 to 7 bytes, with word boundaries) and of itself, hashed
to a table of embeddings that are averaged. A document is two such averages side by side, over all of its words and
over its most toxic passage of 16 words (a word that repeats in a passage counts once there), so a few words are
not thinned out by a long text; one linear softmax reads both. Embeddings and softmax are trained
jointly, and how much either average counts is learned. An unseen misspelling
shares n-grams with the word it comes from; training also shows each word in misspelt forms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import U64, arrow_map, column_bytes, lowered, prefix_hash, range_hash, row_blocks, word_spans
from tidegate.llm.labelled import held_out, training_sample

BUCKETS, DIM, PASSAGE, GRAMS = 1 << 16, 8, 16, (4, 5, 6, 7)
REFRESH = 20
#: A toxic document is predicted from this score on.
THRESHOLD = 0.5
#: Digits that stand for letters in disguised words.
DISGUISE = bytes.maketrans(b"oieast", b"013457")


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, index of its word), the whole word counted once more."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8)
    size = np.array([len(w) + 2 for w in words])
    end = np.cumsum(size)
    return _subwords(data, end - size, end)


def _subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        prefix = prefix_hash(data)
        of = np.repeat(np.arange(len(start)), end - start)
        ids, words = [range_hash(prefix, start, end)], [np.arange(len(start))]
        at = np.arange(len(data))
        for n in GRAMS:
            ok = at + n <= end[of]
            ids.append(range_hash(prefix, at[ok], at[ok] + n))
            words.append(of[ok])
    return (np.concatenate(ids) % U64(BUCKETS)).astype(np.int64), np.concatenate(words)


def _bracketed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copy words out of a text, each between boundary marks: (bytes, starts, ends)."""
    size = end - start
    stop = np.cumsum(size + 2)
    begin = stop - size - 2
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    out[begin], out[stop - 1] = 60, 62
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin + 1, size) + step] = data[np.repeat(start, size) + step]
    return out, begin, stop


def _pulls(model: dict) -> tuple[np.ndarray, np.ndarray, float]:
    """What each n-gram adds to the log-odds by either average, and the bias."""
    odds = (model["W"][:, 1] - model["W"][:, 0]).astype(np.float64)
    return model["E"] @ odds[:DIM], model["E"] @ odds[DIM:], float(model["b"][1] - model["b"][0])


def scores(model: dict, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Probability that a row is toxic, for each row of a block, over all its words."""
    rows = len(offs) - 1
    data = lowered(data)
    start, end, row = word_spans(data, offs)
    whole, passing, base = _pulls(model)
    total = np.full(rows, base)
    if len(start):
        with np.errstate(over="ignore"):
            hashed = range_hash(prefix_hash(data), start, end)
        _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        ids, word = _subwords(*_bracketed(data, start[first], end[first]))
        grams = np.bincount(word, minlength=len(first))
        count = np.bincount(row, minlength=rows)
        total += np.bincount(row, (np.bincount(word, whole[ids], len(first)) / grams)[which], rows) / np.maximum(count, 1)
        value = np.bincount(word, passing[ids], len(first)) / grams
        best = np.full(rows, -np.inf)
        # Passages at two offsets, so that none is cut through everywhere.
        for shift in (0, PASSAGE // 2):
            owner, _, sums = _passages(row, which, value, shift, len(first))
            np.maximum.at(best, owner, sums)
        total[count > 0] += best[count > 0]
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _passages(row: np.ndarray, which: np.ndarray, value: np.ndarray, shift: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages of PASSAGE words of the words' rows (ascending): (row of each, (passage, word) pairs as one number, sum of each over PASSAGE)."""
    place = np.arange(len(row)) - np.searchsorted(row, row)
    passage = (place + shift) // PASSAGE
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (passage[1:] != passage[:-1])])
    number = np.cumsum(new) - 1
    pair = np.unique(number * n_words + which)
    return row[new], pair, np.bincount(pair // n_words, value[pair % n_words]) / PASSAGE


def _misspelt(word: bytes, rng: np.random.Generator) -> bytes:
    if len(word) < 4:
        return word
    k, how = int(rng.integers(1, len(word) - 1)), int(rng.integers(5))
    if how == 0:
        return word[:k] + word[k : k + 1] + word[k:]
    if how == 1:
        return word[:k] + word[k + 1 :]
    if how == 2:
        return word[:k] + word[k + 1 : k + 2] + word[k : k + 1] + word[k + 2 :]
    if how == 3:
        return word[:k] + bytes([int(rng.integers(97, 123))]) + word[k + 1 :]
    return word[:k] + word[k : k + 1].translate(DISGUISE) + word[k + 1 :] if rng.random() < 0.5 else word.translate(DISGUISE)


def train(texts: list[str], labels: list[int], steps: int = 3000, whole: float = 0.5, batch: int = 32, seed: int = 3, rate: float = 0.3, lean: float = 2.0) -> dict:
    """Fit embeddings and softmax jointly by Adagrad in 8 to 60 epochs, the toxic documents weighing `lean` times as much in all as the others.

    In the first share `whole` of the epochs the whole document stands for its most toxic passage too; then that
    is chosen as the model stands, by word values that are renewed every REFRESH steps. With labels of one
    class only, or none, the model answers with that class's share.
    """
    rng = np.random.default_rng(seed)
    model = {"E": rng.normal(0, 0.1, (BUCKETS, DIM)), "W": rng.normal(0, 0.5, (2 * DIM, 2)), "b": np.zeros(2)}
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        model["W"][:] = 0
        model["b"][1] = 4 * (y.mean() if len(y) else 0.5) - 2
        return model
    weight = np.where(y == 1, lean / y.mean(), 1 / (1 - y.mean())) / (1 + lean)
    vocabulary: dict[bytes, int] = {}
    tokens = []
    for t in texts:
        data = lowered(np.frombuffer(t.encode(), np.uint8))
        s, e, _ = word_spans(data, np.array([0, len(data)]))
        raw = data.tobytes()
        tokens.append(np.array([vocabulary.setdefault(raw[a:b], len(vocabulary)) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.int32))
    words = list(vocabulary)
    size = len(words)
    square = {"E": np.full(BUCKETS, 1e-6), "W": np.full((2 * DIM, 2), 1e-6), "b": np.full(2, 1e-6)}
    lots = max(1, len(texts) // batch)
    epochs = min(60, max(8, -(-steps // lots)))
    step = 0
    for epoch in range(epochs):
        if epoch % 2 == 0:  # words in new misspelt forms
            bags = values = None  # the old ones go before the new ones come
            bags = _bags(words + [_misspelt(w, rng) for w in words])
        averaging = epoch < whole * epochs
        for lot in np.array_split(rng.permutation(len(texts)), lots):
            if not averaging and (values is None or step % REFRESH == 0):
                values = _values(bags, _pulls(model)[1])
            step += 1
            seen = [tokens[i] + size * (rng.random(len(tokens[i])) < 0.3) for i in lot]
            row = np.repeat(np.arange(len(lot)), [len(x) for x in seen])
            if not len(row):
                continue
            which = np.concatenate(seen)
            mean = np.unique(row * 2 * size + which, return_counts=True)
            share = mean[1] / np.bincount(row)[mean[0] // (2 * size)]
            if averaging:
                top, top_share = mean[0], share
            else:
                owner, pair, sums = _passages(row, which, values, int(rng.integers(PASSAGE)), 2 * size)
                order = np.lexsort((-sums, owner))
                best = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
                chosen = np.isin(pair // (2 * size), best)
                top = owner[pair[chosen] // (2 * size)] * 2 * size + pair[chosen] % (2 * size)
                top_share = np.full(len(top), 1 / PASSAGE)
            _step(model, square, bags, (mean[0], share, top, top_share), 2 * size, y[lot], weight[lot], rate)
    return model


def _values(bags: tuple[np.ndarray, np.ndarray, np.ndarray], pull: np.ndarray) -> np.ndarray:
    """The mean pull of each word's n-grams."""
    ids, begin, count = bags
    return np.add.reduceat(pull[ids], begin) / count


def _bags(words: list[bytes], step: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram buckets in the order of words, where each word's begin, how many it has)."""
    found, counts = [], []
    for k in range(0, len(words), step):
        ids, word = subwords(words[k : k + step])
        counts.append(np.bincount(word, minlength=len(words[k : k + step])))
        found.append(ids[np.argsort(word, kind="stable")].astype(np.uint16))
    count = np.concatenate(counts)
    return np.concatenate(found), np.cumsum(count) - count, count


def _expand(bags: tuple[np.ndarray, np.ndarray, np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams of a list of words, place in the list)."""
    ids, begin, count = bags
    n = count[words]
    of = np.repeat(np.arange(len(words)), n)
    return ids[begin[words][of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]], of


def _step(model: dict, square: dict, bags: tuple, averages: tuple, n_words: int, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
    """One step on a lot. averages: (document, word) pairs as one number, and the words' shares, of the whole documents and of their passages."""
    mean, share, top, top_share = averages
    n = len(y)
    words, inverse = np.unique(np.concatenate([mean, top]) % n_words, return_inverse=True)
    gram, of = _expand(bags, words)
    size = bags[2][words]
    vectors = np.add.reduceat(model["E"][gram], np.cumsum(size) - size, axis=0) / size[:, None]
    parts = ((mean // n_words, inverse[: len(mean)], share), (top // n_words, inverse[len(mean) :], top_share))
    both = np.concatenate([np.stack([np.bincount(doc, vectors[w, k] * s, n) for k in range(DIM)], axis=1) for doc, w, s in parts], axis=1)
    logit = both @ model["W"] + model["b"]
    p = np.exp(logit - logit.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p *= (weight / n)[:, None]
    # With two classes the columns of p are opposite, so every n-gram is pushed along two directions only.
    odds = model["W"][:, 1] - model["W"][:, 0]
    push = [np.bincount(w, p[doc, 1] * s, len(words)) / size for doc, w, s in parts]
    for k, g in (("W", both.T @ p), ("b", p.sum(axis=0))):
        square[k] += g * g
        model[k] -= 0.3 * rate * g / np.sqrt(square[k])
    touched = np.flatnonzero(np.bincount(gram, minlength=BUCKETS))
    by_mean, by_top = (np.bincount(gram, x[of], BUCKETS)[touched] for x in push)
    grad = by_mean[:, None] * odds[:DIM] + by_top[:, None] * odds[DIM:]
    square["E"][touched] += (grad**2).mean(axis=1)
    model["E"][touched] -= rate * grad / np.sqrt(square["E"][touched])[:, None]


def _score_batches(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            parts = [scores(model, part, cut) for _, _, part, cut in row_blocks(data, offs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=["doc_id", "held_out", "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    model = train(*training_sample(docs, labels, "toxic"))
    return {k: v.astype(np.float32) for k, v in model.items()}


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, held_out, score, predicted; one row per input row.

    Null texts count as empty; a text without words gets the softmax's bias alone. Ids may be null or repeat.
    """
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    scored = arrow_map(rows, _score_batches(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
