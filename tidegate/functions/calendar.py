"""Half-hour settlement calendars of a time zone with clock changes, and date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.keys import date_key


def settlement_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("settlement_date"))


def settlement_calendar(days: DataFrame, zone: str = "Europe/London", minutes: int = 30) -> DataFrame:
    """days(settlement_date) -> a row per period: 48 on ordinary days, 46 or 50 where the clock changes, which dst_flag marks."""
    start = F.to_utc_timestamp(F.col("settlement_date").cast("timestamp"), zone)
    end = F.to_utc_timestamp(F.date_add("settlement_date", 1).cast("timestamp"), zone)
    step = F.expr(f"interval {minutes} minutes")
    starts = days.select("settlement_date", F.sequence(start, end - step, step).alias("starts"))
    slots = starts.select("settlement_date", F.size("starts").alias("periods"), F.posexplode("starts").alias("at", "start_utc"))
    local = F.from_utc_timestamp("start_utc", zone)
    ordinary = 24 * 60 // minutes
    return slots.select(
        "settlement_date",
        (F.col("at") + 1).cast("int").alias("period"),
        "start_utc",
        (F.col("start_utc") + step).alias("end_utc"),
        local.alias("local_start"),
        F.lit(minutes).alias("duration_minutes"),
        (F.col("periods") != ordinary).alias("dst_flag"),
        F.lit(1).alias("calendar_version"),
    )


def date_dimension(dates: DataFrame, column: str) -> DataFrame:
    day = F.col(column).cast("date")
    return dates.select(day.alias("date")).where("date is not null").distinct().select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "EEEE").alias("day_name"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"),
    )


def interval_dimension(spark: SparkSession, periods: int = 50) -> DataFrame:
    return spark.range(1, periods + 1).select(F.col("id").cast("int").alias("interval_key"), F.format_string("SP-%02d", F.col("id")).alias("interval_label"))
