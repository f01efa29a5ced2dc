"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a few joins and partial aggregations keyed by node; the number of rounds is
logarithmic in the component size. No component, link list or label map reaches the driver,
and a node with very many neighbours is met by skew-splittable joins, never by a collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import checkpointed, shuffles_freed

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether each edge goes from a leaf to its centre: no node has two smaller neighbours, or a smaller and a larger one."""
    with shuffles_freed(edges.sparkSession):
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u long, v long) -> (node, component): component is the smallest node reachable.

    Nodes without edges do not appear. Self-links and repeated links are ignored; nulls too.
    Raises RuntimeError if MAX_ROUNDS do not suffice, rather than returning a partial labelling.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = checkpointed(now)
    for _ in range(MAX_ROUNDS):
        if _all_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        now = checkpointed(_small_star(_large_star(now)))
    raise RuntimeError("components did not settle")
