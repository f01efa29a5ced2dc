"""What iterated shuffles leave on disk: files go with their checkpoint, and components need no round to see that they are done."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from tidegate.llm import components
from tidegate.llm.common import checkpointed


def _shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(found.size()) if (name := found.apply(k).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_checkpoint(spark):
    before = _shuffle_files(spark)
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    kept = checkpointed(df.join(df.groupBy("k").agg(F.min("id").alias("least")), "k").repartition(3, "least"))
    end = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < end:  # Spark deletes them beside the next action
        time.sleep(0.2)
    assert not left
    assert kept.count() == 1000 and kept.where("least <> k").count() == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def _roots(pairs: list[tuple[int, int]]) -> dict[int, int]:
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    while any(root[a] != root[b] for a, b in pairs if a != b):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    return root


def _components(spark, monkeypatch, pairs: list[tuple[int, int]]) -> tuple[dict[int, int], int]:
    """The components and the rounds that they took."""
    done = []
    monkeypatch.setattr(components, "checkpointed", lambda df: done.append(1) or checkpointed(df))
    rows = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["component"] for r in rows}, len(done) - 1


def test_stars_take_no_round(spark, monkeypatch):
    pairs = [(0, 7), (9, 0), (-5, 3), (3, -5), (4, 4)]
    assert _components(spark, monkeypatch, pairs) == (_roots(pairs), 0)


def test_components_of_paths_and_random_graphs(spark, monkeypatch):
    draw = random.Random(5)
    path = list(range(40))
    draw.shuffle(path)
    pairs = list(zip(path, path[1:], strict=False))  # one long path
    pairs += [(draw.randrange(100, 260), draw.randrange(100, 260)) for _ in range(90)]
    pairs += [(300, 301), (301, 302), (300, 302), (302, 300)]
    found, rounds = _components(spark, monkeypatch, pairs)
    assert found == _roots(pairs) and 1 <= rounds < 10
