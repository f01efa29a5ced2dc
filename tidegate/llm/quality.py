"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over overlapping chunks that cover the whole document,
each filter keeps its maximum and its mean per chunk (so a chunk tells both that a pattern occurs
and how much of the text it is), a hidden layer turns them into chunk features, and the features'
mean and maximum over all chunks give one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import arrow_map, column_bytes, row_blocks
from tidegate.llm.labelled import held_out, training_sample

CHUNK, STEP, STRIDE, FILTER = 256, 192, 2, 8
EMBED, FILTERS, HIDDEN = 6, 24, 16
#: A document of label 1 is predicted from this score on.
THRESHOLD = 0.3
_POSITIONS = (CHUNK - FILTER) // STRIDE + 1
_WEIGHTS = ("E", "W", "b", "H", "c", "V", "d")


def chunk_starts(length: int) -> list[int]:
    """Starts of overlapping chunks that cover `length` bytes; an empty text has one empty chunk."""
    return [0] if length <= CHUNK else [*range(0, length - CHUNK, STEP), length - CHUNK]


def chunk_table(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """((chunks, CHUNK) bytes with short texts padded by zeros, row of each chunk)."""
    size = offs[1:] - offs[:-1]
    parts = np.where(size <= CHUNK, 1, -(-(size - CHUNK) // STEP) + 1)
    row = np.repeat(np.arange(len(size)), parts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = offs[:-1][row] + np.minimum(number * STEP, np.maximum(size[row] - CHUNK, 0))
    at = start[:, None] + np.arange(CHUNK)
    inside = at < offs[1:][row][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(at, len(data))], np.uint8(0)), row


def _responses(model: dict, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows (chunks, positions, FILTER * EMBED), rectified filter responses)."""
    embedded = model["E"][chunks].reshape(len(chunks), -1)
    windows = np.lib.stride_tricks.sliding_window_view(embedded, FILTER * EMBED, axis=1)[:, :: STRIDE * EMBED]
    windows = np.ascontiguousarray(windows)
    return windows, np.maximum(windows @ model["W"] + model["b"], 0)


def _combine(model: dict, pooled: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunk features, their mean and maximum per row, and the rows' logits."""
    hidden = np.tanh(pooled @ model["H"] + model["c"])
    first = np.searchsorted(row, np.arange(rows))
    count = np.bincount(row, minlength=rows)[:, None]
    mean, top = np.add.reduceat(hidden, first) / count, np.maximum.reduceat(hidden, first)
    return hidden, mean, top, np.concatenate([mean, top], axis=1) @ model["V"] + model["d"]


def _pool(model: dict, chunks: np.ndarray, step: int = 512) -> np.ndarray:
    out = []
    for k in range(0, len(chunks), step):
        _, r = _responses(model, chunks[k : k + step])
        out.append(np.concatenate([r.max(axis=1), r.mean(axis=1)], axis=1))
    return np.concatenate(out)


def scores(model: dict, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row of a block, over its whole bytes."""
    if len(offs) < 2:
        return np.zeros(0)
    chunks, row = chunk_table(data, offs)
    logit = _combine(model, _pool(model, chunks), row, len(offs) - 1)[3]
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


def train(texts: list[str], labels: list[int], steps: int = 1500, batch: int = 24, seed: int = 5, rate: float = 4e-3, chunks_per_text: int = 12) -> dict:
    """Fit all layers jointly by Adam on the cross-entropy, classes weighted alike, in 6 to 30 epochs of about `steps` steps in all.

    Texts of more than chunks_per_text chunks are fitted on that many, drawn anew in each epoch. With
    labels of one class only, or none, the model answers with that class's share.
    """
    rng = np.random.default_rng(seed)
    model = {
        "E": rng.normal(0, 0.5, (256, EMBED)), "W": rng.normal(0, (FILTER * EMBED) ** -0.5, (FILTER * EMBED, FILTERS)), "b": np.zeros(FILTERS),
        "H": rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)), "c": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, 2 * HIDDEN), "d": np.zeros(1),
    }
    model = {k: v.astype(np.float32) for k, v in model.items()}
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        model["V"][:] = 0
        model["d"][:] = 4 * (y.mean() if len(y) else 0.5) - 2
        return model
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step, lots = 0, max(1, len(raw) // batch)
    epochs = min(30, max(6, -(-steps // lots)))
    total = epochs * lots
    for _ in range(epochs):
        for lot in np.array_split(rng.permutation(len(raw)), lots):
            tables = []
            for i in lot:
                table = chunk_table(raw[i], np.array([0, len(raw[i])]))[0]
                if len(table) > chunks_per_text:
                    table = table[np.sort(rng.choice(len(table), chunks_per_text, replace=False))]
                tables.append(table)
            chunks, row = np.concatenate(tables), np.repeat(np.arange(len(lot)), [len(t) for t in tables])
            grads = _gradients(model, chunks, row, y[lot], weight[lot])
            step += 1
            now = rate * min(1, 2 * (1 - step / (total + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                model[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def _gradients(model: dict, chunks: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    n = len(y)
    windows, response = _responses(model, chunks)
    best = response.argmax(axis=1)
    pooled = np.concatenate([np.take_along_axis(response, best[:, None, :], 1)[:, 0], response.mean(axis=1)], axis=1)
    hidden, mean, top, logit = _combine(model, pooled, row, n)
    error = (weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n).astype(np.float32)
    both = np.concatenate([mean, top], axis=1)
    grads = {"V": both.T @ error, "d": error.sum(keepdims=True)}
    d_both = error[:, None] * model["V"]
    count = np.bincount(row, minlength=n)[:, None]
    d_hidden = (d_both[:, :HIDDEN] / count)[row] + d_both[:, HIDDEN:][row] * (hidden == top[row])
    d_hidden *= 1 - hidden**2
    grads["H"], grads["c"] = pooled.T @ d_hidden, d_hidden.sum(axis=0)
    d_pooled = d_hidden @ model["H"].T
    d_response = np.repeat(d_pooled[:, None, FILTERS:] / _POSITIONS, _POSITIONS, axis=1)
    at = (np.arange(len(chunks))[:, None], best, np.arange(FILTERS))
    d_response[at] += d_pooled[:, :FILTERS]
    d_response *= response > 0
    flat, d_flat = windows.reshape(-1, FILTER * EMBED), d_response.reshape(-1, FILTERS)
    grads["W"], grads["b"] = flat.T @ d_flat, d_flat.sum(axis=0)
    d_windows = (d_flat @ model["W"].T).reshape(len(chunks), _POSITIONS, FILTER, EMBED)
    d_embedded = np.zeros((len(chunks), CHUNK, EMBED), np.float32)
    for k in range(FILTER):
        d_embedded[:, k : k + STRIDE * _POSITIONS : STRIDE][:, :_POSITIONS] += d_windows[:, :, k]
    flat, d_flat = chunks.ravel(), d_embedded.reshape(-1, EMBED)
    grads["E"] = np.stack([np.bincount(flat, d_flat[:, k], 256) for k in range(EMBED)], axis=1).astype(np.float32)
    return grads


def _score_batches(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            parts = [scores(model, part, cut) for _, _, part, cut in row_blocks(data, offs, 1 << 19)]
            yield pa.RecordBatch.from_arrays([*batch.select([k for k in batch.schema.names if k != "text"]).columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=[*(k for k in batch.schema.names if k != "text"), "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    return train(*training_sample(docs, labels, "quality"))


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, held_out, score, predicted; one row per input row.

    A null text is scored as an empty one, which is a padded chunk of zeros; ids may be null or repeat.
    """
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    scored = arrow_map(rows, _score_batches(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, model: dict) -> DataFrame:
    """docs without the rows scored under the threshold; all columns unchanged."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = column_bytes(batch.column("text"))
            parts = [scores(model, part, cut) for _, _, part, cut in row_blocks(data, offs, 1 << 19)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= THRESHOLD))

    return arrow_map(docs.select(*names), run, docs.schema)
