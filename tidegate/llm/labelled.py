"""Bounded training samples and the split that keeps rows for evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most rows, and the most bytes of their texts, that a classifier is fitted on.
TRAIN_ROWS, TRAIN_BYTES = 6000, 48 << 20


def held_out(doc_id: str) -> F.Column:
    """True where crc32(doc_id as text) mod 5 is 0; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> tuple[list[str], list[int]]:
    """Whole texts and labels to fit on: at most max_rows labelled rows, half of them of label 1 where there are so many.

    Rows held out, and rows with a null label, id or text, are never drawn. The draw is by a hash of the
    id, so it is the same on every run and does not depend on the order of rows. Rows are taken in that
    order while their texts fit into max_bytes together; one that does not fit is passed over.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.md5(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")).cast("binary"))
    parts = [known.where(F.col("y") == y).orderBy(order).limit(max_rows // 2) for y in (0, 1)]
    drawn = parts[0].unionByName(parts[1])  # at most max_rows ids, so small enough to send to every task
    texts = docs.select("doc_id", "text").where("text is not null")
    size = F.max(F.octet_length("text")).alias("n")
    sizes = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(size).orderBy(order).collect()  # at most max_rows numbers
    chosen, room = [], max_bytes
    for r in sizes:
        if r["n"] <= room:
            chosen.append((r["doc_id"], r["y"]))
            room -= r["n"]
    if not chosen:
        return [], []
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    longest = F.max_by("text", F.struct(F.octet_length("text"), "text")).alias("text")
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(longest).orderBy(order).collect()
    return [r["text"] for r in rows], [r["y"] for r in rows]
