"""Sessions with the time and overwrite rules that all layers rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Naive timestamps are UTC; a partition overwrite touches only the partitions it brings.
RULES = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.timestampType": "TIMESTAMP_LTZ",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "tidegate", **conf: str) -> SparkSession:
    """A session under RULES; master, memory and shuffle partitions are the cluster's to set, or given in conf."""
    builder = SparkSession.builder.appName(name)
    for k, v in (RULES | {"spark.sql.adaptive.enabled": "true"} | conf).items():
        builder = builder.config(k, v)
    return with_rules(builder.getOrCreate())


def with_rules(spark: SparkSession) -> SparkSession:
    """Put the rules on a session that somebody else made."""
    for k, v in RULES.items():
        spark.conf.set(k, v)
    return spark
