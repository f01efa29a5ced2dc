"""Proportional stratified interleaving, with DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; a row's place in the whole is its
fractional rank (rank - 1/2) / size of its source, so any stretch of that order holds the sources in
the proportions of the corpus, and cutting it into equal stretches gives shards that all match.

Neither ranking puts a source or the corpus in one task: rows are dealt to buckets of bounded
size (by hash prefix, then by fraction), numbered within the bucket, and shifted by the running
total of the bucket counts. Running totals are taken in two levels, over SPAN buckets and over the
spans, so no task sees all buckets. The hash is of the whole row and of its number among equal rows, so
neither a hot source nor a hot row fills a bucket. The text itself is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import checkpointed

BUCKET_ROWS, SPAN = 4000, 1024


def running_totals(counts: DataFrame, within: list[str], at: str, n: str, out: str, span: int = SPAN) -> DataFrame:
    """counts with a column `out`: the sum of n over the rows of smaller `at` (distinct within the columns `within`).

    Sums within spans of `at`, then over the spans: the last window has one row per span.
    """
    before = lambda w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_span", F.floor(F.col(at) / span).cast("long"))
    spans = counts.groupBy(*within, "_span").agg(F.sum(n).alias(n))
    spans = spans.withColumn("_ahead", before(Window.partitionBy(*within).orderBy("_span")))
    spans = spans.select(*(F.col(c).alias(f"_of_{c}") for c in (*within, "_span")), "_ahead")
    inner = counts.withColumn(out, before(Window.partitionBy(*within, "_span").orderBy(at)))
    on = [inner[c].eqNullSafe(spans[f"_of_{c}"]) for c in (*within, "_span")]
    return inner.join(spans, on).withColumn(out, F.col(out) + F.col("_ahead")).select(*counts.drop("_span").columns, out)


def interleaved_shards(docs: DataFrame, n_shards: int = 24, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs(doc_id, text, source, ...) -> doc_id, size, text_crc32, law, shard, slot, grown_shard, source.

    Law `rows`: shard counts differ by one at most. size is the UTF-8 length of the text plus 8
    (a null text has none: 8, and crc32 of nothing, 0). A null source is a source of its own; a null id is an id like others. Rows
    with equal id, source, size and crc32 are interchangeable; otherwise the order is total, so the result
    does not depend on partitioning. An empty table gives no rows. Other columns of docs are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.col("source").alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    columns = ["doc_id", "source", "size", "text_crc32"]
    # Equal rows are counted on the map side and numbered, so each has a hash of its own.
    rows = rows.groupBy(*columns).agg(F.count("*").alias("_copies")).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
    content = F.concat_ws("|", F.lit(f"{seed}"), *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (*columns, "_copy")))
    rows = checkpointed(rows.withColumn("_h", F.md5(content.cast("binary"))))
    total = rows.count()
    buckets = 1 << max(0, (max(1, -(-total // bucket_rows)) - 1).bit_length())
    shift = (16**8) // buckets
    rows = rows.withColumn("_b", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") / F.lit(shift)).cast("long"))
    # Salting by hash prefix splits a hot source over all buckets.
    counts = rows.groupBy("source", "_b").agg(F.count("*").alias("_n"))
    sizes = counts.groupBy(F.col("source").alias("_ss")).agg(F.sum("_n").alias("_of"))
    offsets = running_totals(counts, ["source"], "_b", "_n", "_before").select(F.col("source").alias("_s"), F.col("_b").alias("_bb"), "_before")
    offsets = offsets.join(sizes, F.col("_s").eqNullSafe(F.col("_ss"))).drop("_ss")
    within = Window.partitionBy("source", "_b").orderBy("_h", *columns, "_copy")
    ranked = rows.withColumn("_r", F.row_number().over(within)).join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_bb")))
    ranked = ranked.withColumn("_f", (F.col("_before") + F.col("_r") - 0.5) / F.col("_of"))
    ranked = ranked.withColumn("_c", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("long"))
    ranked = checkpointed(ranked.select(*columns, "_copy", "_h", "_f", "_c"))
    cells = ranked.groupBy("_c").agg(F.count("*").alias("_n"))
    starts = running_totals(cells, [], "_c", "_n", "_start").select(F.col("_c").alias("_cc"), "_start")
    within = Window.partitionBy("_c").orderBy("_f", "source", "_h", *columns, "_copy")
    placed = ranked.withColumn("_i", F.row_number().over(within)).join(starts, F.col("_c") == F.col("_cc"))
    place = F.col("_start") + F.col("_i") - 1
    placed = placed.withColumn("_p", place.cast("long")).withColumn("shard", F.expr(f"_p * {n_shards} div {max(1, total)}").cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {n_shards - 1}) div {n_shards}")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_p") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")
