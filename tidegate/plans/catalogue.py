"""The operators as queries over the star-schema tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.calendar import date_dimension, interval_dimension, settlement_calendar, settlement_days
from tidegate.functions.keys import date_key, surrogate
from tidegate.operators import checks, history, merge, rows, star
from tidegate.operators.control import publishable, reconcile
from tidegate.plans.replay import scratch
from tidegate.sources.tables import Table

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables(NamedTuple):
    spark: SparkSession
    at: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/{name}.parquet")


def query(sql: str | None = None):
    def keep(f: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        FOUND[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return run

    return keep


def ntz(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


@query("""SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, CAST(o_totalprice AS DECIMAL(18,3)) AS total,
    CAST(o_orderdate AS DATE) AS order_date, o_orderstatus = 'F' AS finished, CAST(NULL AS INTEGER) AS priority_number FROM orders""")
def canonical_typed_scan(t):
    """Typed projection; text that is no number becomes null instead of failing."""
    return t("orders").select(
        F.col("o_orderkey").cast("long").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"), F.col("o_totalprice").cast("decimal(18,3)").alias("total"),
        F.col("o_orderdate").cast("date").alias("order_date"), (F.col("o_orderstatus") == "F").alias("finished"), F.col("o_orderpriority").try_cast("int").alias("priority_number"),
    )


@query("""SELECT event_id, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'click' THEN 'UPDATE' WHEN 'view' THEN 'UPDATE' WHEN 'error' THEN 'DELETE' END AS operation FROM events""")
def code_mapping(t):
    """Codes to operations; an unknown code gives null."""
    return t("events").select("event_id", operation().alias("operation"))


def operation() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "signup", "INSERT").when(kind.isin("click", "view"), "UPDATE").when(kind == "error", "DELETE")


REASONS = """CASE WHEN l_quantity > 45 THEN 'LARGE_QUANTITY' WHEN l_discount > 0.08 THEN 'DEEP_DISCOUNT'
    WHEN l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N') THEN 'INVALID_FLAG' WHEN l_extendedprice < 1000 THEN 'LOW_PRICE' END"""


def line_rules() -> list[tuple[str, Column]]:
    flag = F.col("l_returnflag")
    return [
        ("LARGE_QUANTITY", F.col("l_quantity") > 45),
        ("DEEP_DISCOUNT", F.col("l_discount") > 0.08),
        ("INVALID_FLAG", flag.isNull() | ~flag.isin("A", "N")),
        ("LOW_PRICE", F.col("l_extendedprice") < 1000),
    ]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {REASONS} AS rejection_reason FROM lineitem")
def reject_classifier(t):
    """First matching reason in order of precedence; null for accepted rows."""
    return rows.with_reason(t("lineitem"), line_rules()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rejection_reason")


@query(f"SELECT coalesce({REASONS}, 'ACCEPTED') AS outcome, count(*) AS n FROM lineitem GROUP BY 1")
def accept_reject_split_counts(t):
    """Accepted and rejected halves of one input, counted."""
    judged = rows.with_reason(t("lineitem"), line_rules())
    return judged.groupBy(F.coalesce("rejection_reason", F.lit("ACCEPTED")).alias("outcome")).agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS shipdate FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""")
def latest_per_key(t):
    """Newest row per key with a total order."""
    latest = rows.latest_by(t("lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_shipdate").desc_nulls_last(), F.desc("l_partkey"), F.desc("l_suppkey"))
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("shipdate"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber AS version, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber DESC, l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""")
def highest_version_wins(t):
    """Highest version per id, then newest commit."""
    best = rows.latest_by(t("lineitem"), ["l_orderkey"], F.desc("l_linenumber"), F.col("l_shipdate").desc_nulls_last(), F.desc("l_partkey"), F.desc("l_suppkey"))
    return best.select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("version"), "l_quantity")


@query("""SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_control_version(t):
    """Newest version per composite business key."""
    return rows.latest_by(t("orders"), ["o_custkey", "o_orderpriority"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
    FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def current_state_without_deletes(t):
    """Newest state per user; gone if the newest is a delete."""
    changes = t("events").withColumn("operation", operation())
    return rows.current_state(changes, ["user_id"], "operation", F.col("ts").desc_nulls_last(), F.desc("event_id")).select("user_id", "event_id", "event_type")


MERGE_SIDES = """WITH v AS (SELECT l_orderkey AS id, max(l_linenumber) AS version, sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty, l_shipdate < TIMESTAMP '1997-01-01' AS old
    FROM lineitem GROUP BY l_orderkey, l_shipdate < TIMESTAMP '1997-01-01'), t AS (SELECT * FROM v WHERE old), s AS (SELECT * FROM v WHERE NOT old)"""


def merge_sides(t) -> tuple[DataFrame, DataFrame]:
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    lines = t("lineitem").withColumn("old", ntz("l_shipdate") < cut)
    each = lines.groupBy(F.col("l_orderkey").alias("id"), "old").agg(F.max("l_linenumber").alias("version"), money(F.sum(money(F.col("l_quantity")))).alias("qty"))
    return each.where("old").drop("old"), each.where("not old").drop("old")


@query(MERGE_SIDES + """ SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL OR s.version >= t.version THEN s.version ELSE t.version END AS version,
    CAST(CASE WHEN t.id IS NULL OR s.version >= t.version THEN s.qty ELSE t.qty END AS DECIMAL(18,2)) AS qty FROM t FULL JOIN s ON t.id = s.id""")
def merge_upsert_guarded(t):
    """Upsert where an equal or higher version replaces."""
    target, source = merge_sides(t)
    return merge.merge_rows(target, source, ["id"], lambda s, o: s("version") >= o("version"))


@query("""WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS old, row_number() OVER (PARTITION BY user_id, ts < TIMESTAMP '2024-01-16' ORDER BY value DESC, event_id) AS rn FROM events),
    t AS (SELECT * FROM e WHERE old AND rn = 1), s AS (SELECT * FROM e WHERE NOT old AND rn = 1)
    SELECT coalesce(t.user_id, s.user_id) AS user_id, CASE WHEN t.user_id IS NULL OR s.value > t.value THEN s.event_id ELSE t.event_id END AS event_id,
    CASE WHEN t.user_id IS NULL OR s.value > t.value THEN s.value ELSE t.value END AS value FROM t FULL JOIN s ON t.user_id = s.user_id""")
def merge_recency_guarded(t):
    """Upsert where only a strictly greater value replaces."""
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    best = rows.latest_by(t("events").withColumn("old", ntz("ts") < cut), ["user_id", "old"], F.desc("value"), F.asc("event_id")).select("user_id", "event_id", "value", "old")
    return merge.merge_rows(best.where("old").drop("old"), best.where("not old").drop("old"), ["user_id"], lambda s, o: s("value") > o("value"))


@query("""WITH c AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, max(l_shipdate) AS at FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CAST(CASE WHEN coalesce(c.at > o_orderdate + INTERVAL 90 DAY, false) THEN c.total ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS price,
    coalesce(c.at > o_orderdate + INTERVAL 90 DAY, false) AS corrected FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def correction_overlay(t):
    """Update-only merge: a correction wins only if it is strictly newer."""
    fixes = t("lineitem").groupBy("l_orderkey").agg(money(F.sum(money(F.col("l_extendedprice")))).alias("total"), F.max(ntz("l_shipdate")).alias("at")).withColumnRenamed("l_orderkey", "o_orderkey")
    target = t("orders").select("o_orderkey", money(F.col("o_totalprice")).alias("price"), (ntz("o_orderdate") + F.expr("interval 90 days")).alias("limit"))
    return merge.overlay(target, fixes, "o_orderkey", ("at", "limit"), {"price": "total"}, "corrected").select("o_orderkey", "price", "corrected")


HISTORY = """WITH a AS (SELECT user_id, event_type, ts, event_id, lag(event_type) OVER w AS prev, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    k AS (SELECT *, row_number() OVER w AS v, lead(ts) OVER w AS nxt FROM a WHERE n = 1 OR prev IS DISTINCT FROM event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    h AS (SELECT user_id, event_type, CASE WHEN v = 1 THEN TIMESTAMP '1900-01-01' ELSE ts END AS valid_from, coalesce(nxt, TIMESTAMP '9999-12-31') AS valid_to, nxt IS NULL AS is_current FROM k)"""


def event_history(t) -> DataFrame:
    h = history.scd2(t("events"), "user_id", ["event_type"], "ts", F.asc("event_id"))
    return h.withColumn("valid_from", ntz("valid_from")).withColumn("valid_to", ntz("valid_to"))


@query(HISTORY + " SELECT * FROM h")
def scd2_history(t):
    """Versions of a tracked attribute."""
    return event_history(t)


#: Spans of orders that overlap here and there: a customer's order is open for as many days as its key says.
SPANS = "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS valid_to FROM orders"


def order_spans(t) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t("orders").select("o_custkey", "o_orderkey", day.alias("valid_from"), F.date_add(day, (F.col("o_orderkey") % 90).cast("int")).alias("valid_to"))


@query(f"""WITH s AS ({SPANS}), n AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from, valid_to) AS following FROM s)
    SELECT o_custkey, count(*) AS n FROM n WHERE following < valid_to GROUP BY 1""")
def scd2_overlap_check(t):
    """Versions that reach into the next one of their key, where there are some."""
    return history.overlaps(order_spans(t), "o_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query(HISTORY + " SELECT count(*) AS n FROM h a JOIN h b ON a.user_id = b.user_id AND a.valid_from < b.valid_from AND b.valid_from < a.valid_to")
def scd2_built_without_overlaps(t):
    """A built history has no overlaps; the oracle looks at all pairs of versions."""
    return history.overlaps(event_history(t), "user_id").agg(F.count("*").alias("n"))


@query(f"""WITH s AS ({SPANS}), f AS (SELECT c_custkey, d.day FROM customer, (SELECT DATE '1996-01-01' + CAST(i * 40 AS INTEGER) AS day FROM range(0, 20) r(i)) d)
    SELECT c_custkey, day, count(s.o_orderkey) AS open_orders, max(s.o_orderkey) AS newest FROM f LEFT JOIN s ON o_custkey = c_custkey AND day >= valid_from AND day < valid_to GROUP BY 1, 2""")
def effective_dated_join_by_date(t):
    """Days and the versions valid on them, by date: start <= day < end; several where versions overlap, none where there is a gap."""
    days = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.date_add(F.lit("1996-01-01").cast("date"), i * 40))
    facts = t("customer").select("c_custkey", F.explode(days).alias("day"))
    found = history.effective_join(facts, order_spans(t), ("c_custkey", "o_custkey"), "day", "valid_from", "valid_to", {"order": "o_orderkey"})
    return found.groupBy("c_custkey", "day").agg(F.count("order").alias("open_orders"), F.max("order").alias("newest"))


@query(HISTORY + " SELECT event_id, e.user_id, h.event_type AS version_type, h.valid_from FROM events e LEFT JOIN h ON e.user_id = h.user_id AND e.ts >= h.valid_from AND e.ts < h.valid_to")
def effective_dated_join(t):
    """Each event with the version valid at its time."""
    facts = t("events").select("event_id", "user_id", ntz("ts").alias("ts"))
    found = history.effective_join(facts, event_history(t), ("user_id", "user_id"), "ts", "valid_from", "valid_to", {"version_type": "event_type", "valid_since": "valid_from"})
    return found.select("event_id", "user_id", "version_type", F.col("valid_since").alias("valid_from"))


@query("""SELECT c_custkey, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def broadcast_lookup(t):
    """Enrichment from two tables of fixed size; Spark broadcasts them by their size on disk."""
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS has_lines FROM orders")
def known_key_probe(t):
    """Whether the key is known, for every row."""
    return rows.known_keys(t("orders").withColumnRenamed("o_orderkey", "l_orderkey"), t("lineitem"), "l_orderkey", "has_lines").select(F.col("l_orderkey").alias("o_orderkey"), "has_lines")


@query("""SELECT 'orders' AS side, o_orderkey AS key FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)
    UNION ALL SELECT DISTINCT 'lineitem', l_orderkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey)""")
def orphan_keys(t):
    """References that point nowhere, in both directions."""
    left = star.orphans(t("orders"), t("lineitem"), "o_orderkey", "l_orderkey").select(F.lit("orders").alias("side"), "key")
    return left.unionByName(star.orphans(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey").select(F.lit("lineitem").alias("side"), "key"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT -1, 'UNKNOWN', NULL")
def unknown_member(t):
    """A dimension and its unknown member."""
    return star.with_unknown_member(t("nation").select("n_nationkey", "n_name", "n_regionkey"), "n_nationkey")


@query("""SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month, dayname(o_orderdate) AS day_name, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders WHERE o_orderdate IS NOT NULL""")
def dim_date(t):
    return date_dimension(t("orders"), "o_orderdate")


@query("SELECT CAST(i AS INTEGER) AS interval_key, 'SP-' || lpad(CAST(i AS VARCHAR), 2, '0') AS interval_label FROM range(1, 51) r(i)")
def dim_interval(t):
    return interval_dimension(t.spark)


@query("""WITH d AS (SELECT DATE '2026-03-28' + CAST(i AS INTEGER) AS day FROM range(0, 240) r(i)),
    b AS (SELECT day, timezone('Europe/London', CAST(day AS TIMESTAMP)) AS a, timezone('Europe/London', CAST(day + 1 AS TIMESTAMP)) AS z FROM d)
    SELECT CAST(day AS DATE) AS settlement_date, CAST((epoch(z) - epoch(a)) / 1800 AS BIGINT) AS periods, (epoch(z) - epoch(a)) / 1800 <> 48 AS changed FROM b""")
def dst_calendar(t):
    """Periods of each day around both clock changes of a year: 46, 48 or 50, and the flag of the days of the change."""
    return settlement_calendar(settlement_days(t.spark, "2026-03-28", "2026-11-22")).groupBy("settlement_date").agg(F.count("*").alias("periods"), F.bool_and("dst_flag").alias("changed"))


@query("""SELECT user_id, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,3))) AS DECIMAL(28,3)) AS total, CAST(count(*) AS INTEGER) AS n, arg_max(event_type, ts) AS last_type
    FROM events GROUP BY user_id, CAST(ts AS DATE)""")
def daily_aggregate_argmax(t):
    """Daily totals and the attribute of the day's last row."""
    day = t("events").groupBy("user_id", F.col("ts").cast("date").alias("day"))
    return day.agg(F.sum(F.col("value").cast("decimal(18,3)")).cast("decimal(28,3)").alias("total"), F.count("*").cast("int").alias("n"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


@query("""WITH e AS (SELECT date_trunc('hour', ts) AS hour, count(DISTINCT user_id) AS seen FROM events GROUP BY 1), u AS (SELECT count(DISTINCT user_id) AS n FROM events)
    SELECT hour, seen, round(CAST(seen AS DOUBLE) / n, 6) AS completeness FROM e, u""")
def completeness_ratio(t):
    """Seen against expected, as a share."""
    e = t("events")
    hours = e.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count_distinct("user_id").alias("seen"))
    expected = e.agg(F.count_distinct("user_id").alias("n")).scalar()
    return hours.select(ntz("hour").alias("hour"), "seen", F.round(F.col("seen").cast("double") / expected, 6).alias("completeness"))


CONTROL = """WITH l AS (SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS month, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS target_total, count(*) AS target_count FROM lineitem GROUP BY 1),
    c AS (SELECT month, CASE WHEN month % 7 = 0 THEN target_total + 1000 WHEN month % 11 = 3 THEN NULL ELSE target_total END AS expected_total,
        CASE WHEN month % 5 = 0 THEN target_count + 1 ELSE target_count END AS expected_count FROM l UNION ALL SELECT 209912, 10, 1),
    r AS (SELECT c.month, CAST(expected_total AS DECIMAL(24,4)) AS expected_total, expected_count, CAST(target_total AS DECIMAL(24,4)) AS target_total, target_count,
        CASE WHEN target_total IS NULL THEN 'MISSING_TARGET' WHEN expected_total IS NULL THEN 'MISSING_CONTROL' WHEN target_count <> expected_count THEN 'BLOCKED_COUNT'
        WHEN abs(target_total - expected_total) / expected_total * 100 > 0.01 THEN 'BLOCKED_TOTAL' ELSE 'PASSED' END AS status FROM c LEFT JOIN l ON c.month = l.month)"""


def monthly_reconciliation(t) -> DataFrame:
    month = F.date_format("l_shipdate", "yyyyMM").cast("int").alias("month")
    built = t("lineitem").groupBy(month).agg(F.sum(money(F.col("l_extendedprice"))).cast("decimal(24,4)").alias("target_total"), F.count("*").alias("target_count"))
    m, total = F.col("month"), F.col("target_total")
    controls = built.select(
        "month",
        F.when(m % 7 == 0, total + F.lit(1000).cast("decimal(5,0)")).when(m % 11 == 3, None).otherwise(total).cast("decimal(24,4)").alias("expected_total"),
        F.when(m % 5 == 0, F.col("target_count") + 1).otherwise(F.col("target_count")).alias("expected_count"),
    )
    absent = t.spark.range(1).select(F.lit(209912).alias("month"), F.lit(10).cast("decimal(24,4)").alias("expected_total"), F.lit(1).cast("long").alias("expected_count"))
    return reconcile(controls.unionByName(absent), built, ["month"])


@query(CONTROL + " SELECT month, expected_total, expected_count, target_total, target_count, status FROM r")
def reconcile_totals(t):
    """Control totals against built totals, every status occurring."""
    return monthly_reconciliation(t).select("month", "expected_total", "expected_count", "target_total", "target_count", "status")


@query(CONTROL + """ SELECT l_returnflag, month, count(*) AS n FROM lineitem JOIN r ON month = CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) WHERE status = 'PASSED' GROUP BY 1, 2""")
def gated_publish(t):
    """Only what passed reconciliation is published."""
    month = F.date_format("l_shipdate", "yyyyMM").cast("int")
    report = t("lineitem").groupBy("l_returnflag", month.alias("month")).agg(F.count("*").alias("n"))
    return publishable(report, monthly_reconciliation(t), ["month"]).select("l_returnflag", "month", "n")


@query("""SELECT 'order_key_unique' AS check_name, CAST(count(*) - count(DISTINCT o_orderkey) AS DOUBLE) AS value, count(*) = count(DISTINCT o_orderkey) AS passed FROM orders
    UNION ALL SELECT 'price_present', CAST(count(*) FILTER (WHERE o_totalprice IS NULL) AS DOUBLE), count(*) FILTER (WHERE o_totalprice IS NULL) = 0 FROM orders
    UNION ALL SELECT 'open_share', round(count(*) FILTER (WHERE o_orderstatus = 'O') / CAST(count(*) AS DOUBLE), 6), count(*) FILTER (WHERE o_orderstatus = 'O') / CAST(count(*) AS DOUBLE) <= 0.01 FROM orders
    UNION ALL SELECT 'orphan_customers', CAST(count(DISTINCT o_custkey) AS DOUBLE), count(*) = 0 FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey)""")
def dq_summary(t):
    """Grain, presence and shares of one table in one pass, and its orphans."""
    orders = t("orders")
    found = checks.evaluate(orders, [
        checks.Check("order_key_unique", checks.duplicates("o_orderkey")),
        checks.Check("price_present", checks.count_where(F.col("o_totalprice").isNull())),
        checks.Check("open_share", checks.share_where(F.col("o_orderstatus") == "O"), 0.01, "warn"),
    ])
    lost = checks.evaluate(star.orphans(orders, t("customer"), "o_custkey", "c_custkey"), [checks.Check("orphan_customers", F.count("*"))])
    return found.unionByName(lost).select("check_name", F.round("value", 6).alias("value"), "passed")


def table(t, partition: str | None = None) -> Table:
    """A new table in the shared folder."""
    return Table(t.spark, scratch(t.spark), partition)


def priced(t) -> DataFrame:
    return t("orders").select("o_orderkey", "o_orderstatus", money(F.col("o_totalprice")).alias("price"), F.year("o_orderdate").alias("year"))


TOTALS = "count(*) AS n, CAST(sum({}) AS DECIMAL(28,2)) AS total"
PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


def totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum("price").cast("decimal(28,2)").alias("total"))


@query(f"SELECT CAST(year(o_orderdate) AS INTEGER) AS year, year(o_orderdate) % 2 = 0 AS rebuilt, {TOTALS.format(f'CASE WHEN year(o_orderdate) % 2 = 0 THEN {PRICE} + 1 ELSE {PRICE} END')} FROM orders GROUP BY 1, 2")
def dynamic_partition_overwrite(t):
    """A partitioned table after the partitions of even years were replaced: those alone are written."""
    base = priced(t).withColumn("rebuilt", F.lit(False))
    target = table(t, "year")
    target.append(base)
    even = base.where("year % 2 = 0").withColumn("price", money(F.col("price") + 1)).withColumn("rebuilt", F.lit(True))
    target.overwrite_partitions(even)
    return totals(target.read(), "year", "rebuilt")


@query(f"SELECT o_orderstatus, {TOTALS.format(PRICE)} FROM orders GROUP BY 1")
def idempotent_rerun(t):
    """A change set merged into a partitioned table twice leaves what merging it once left."""
    target = table(t, "year")
    target.append(priced(t).where("o_orderkey % 2 = 0"))
    for change in ("o_orderkey % 2 = 1", "o_orderkey % 3 = 0", "o_orderkey % 3 = 0"):
        target.merge(priced(t).where(change), ["o_orderkey"])
    return totals(target.read(), "o_orderstatus")


@query(f"""SELECT CASE WHEN o_orderkey % 5 = 0 THEN 2000 ELSE CAST(year(o_orderdate) AS INTEGER) END AS year, {TOTALS.format(f'CASE WHEN o_orderkey % 5 = 0 THEN {PRICE} * 2 ELSE {PRICE} END')}
    FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1""")
def merge_moves_partitions(t):
    """A guarded merge whose newer rows move to another partition and leave none behind, then a delete by key."""
    target = table(t, "year")
    target.append(priced(t).withColumn("version", F.lit(1)))
    moved = priced(t).where("o_orderkey % 5 = 0").select("o_orderkey", "o_orderstatus", money(F.col("price") * 2).alias("price"), F.lit(2000).alias("year"), F.lit(2).alias("version"))
    newer = lambda s, o: s("version") >= o("version")
    target.merge(moved, ["o_orderkey"], newer)
    target.merge(priced(t).where("o_orderkey % 10 = 0").withColumn("version", F.lit(1)), ["o_orderkey"], newer)  # older: changes nothing
    target.delete_keys(priced(t).where("o_orderkey % 7 = 0"), ["o_orderkey"])
    return totals(target.read(), "year")


@query(f"SELECT run, {TOTALS.format('price')} FROM (SELECT 'b' AS run, {PRICE} + 1 AS price FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'a', {PRICE} FROM orders) GROUP BY 1")
def rerun_replaces_its_slice(t):
    """A run's rows are taken out and written again; those of other runs stay."""
    target = table(t, "run")
    for run, part, more in (("a", "true", 0), ("b", "o_orderkey % 3 = 0", 9), ("b", "o_orderkey % 2 = 0", 1)):
        target.overwrite_partitions(priced(t).where(part).withColumn("price", money(F.col("price") + more)).withColumn("run", F.lit(run)), [run])
    return totals(target.read(), "run")


@query("""SELECT 'now' AS at, channel, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 2 = 1 THEN 'web' END AS channel FROM orders) GROUP BY 2
    UNION ALL SELECT 'before', NULL, count(*) FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'replaced', NULL, count(*) FROM orders WHERE o_orderstatus = 'F'""")
def table_grows_and_is_replaced(t):
    """An append with a new column, the snapshot before it, and a replacement of the whole table."""
    target = table(t)
    target.append(priced(t).where("o_orderkey % 2 = 0"))
    target.append(priced(t).where("o_orderkey % 2 = 1").withColumn("channel", F.lit("web")))
    grown = target.read().groupBy("channel").agg(F.count("*").alias("n")).select(F.lit("now").alias("at"), "channel", "n")
    before = target.read(version=1).agg(F.count("*").alias("n")).select(F.lit("before").alias("at"), F.lit(None).cast("string").alias("channel"), "n")
    target.replace(priced(t).where("o_orderstatus = 'F'"))
    after = target.read().agg(F.count("*").alias("n")).select(F.lit("replaced").alias("at"), F.lit(None).cast("string").alias("channel"), "n")
    return grown.unionByName(before).unionByName(after)


@query(f"SELECT * FROM (SELECT {REASONS} AS rejection_reason, CAST(l_orderkey AS VARCHAR) AS order_text, l_returnflag AS flag_text FROM lineitem) WHERE rejection_reason IS NOT NULL")
def reject_payload_json(t):
    """Rejected rows travel as JSON and can be read back."""
    bad = rows.rejected(rows.with_reason(t("lineitem"), line_rules()), "lineitem", "r1")
    return bad.select("rejection_reason", F.get_json_object("payload", "$.l_orderkey").alias("order_text"), F.get_json_object("payload", "$.l_returnflag").alias("flag_text"))


@query("SELECT count(*) AS n, count(DISTINCT (o_custkey, o_orderpriority)) AS keys, true AS stable FROM orders")
def surrogate_key_consistency(t):
    """As many surrogate keys as natural keys, the same when computed again."""
    keyed = t("orders").select("o_custkey", "o_orderpriority", surrogate("o_custkey", "o_orderpriority").alias("sk"))
    again = F.xxhash64(F.concat(F.col("o_custkey").cast("string"), F.lit("|"), F.col("o_orderpriority")))
    return keyed.agg(F.count("*").alias("n"), F.count_distinct("sk").alias("keys"), F.bool_and(F.col("sk") == again).alias("stable"))


@query("""SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS channel FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_orderstatus, 'web' FROM orders WHERE o_orderkey % 2 = 1""")
def schema_align_union(t):
    """A column that appears later is null in older rows."""
    base = t("orders").select("o_orderkey", "o_orderstatus")
    return rows.union_aligned(base.where("o_orderkey % 2 = 0"), base.where("o_orderkey % 2 = 1").withColumn("channel", F.lit("web")))


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def set_difference_keys(t):
    return rows.missing_from(t("orders"), t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("""SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def topk_per_group(t):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t("orders").withColumn("place", F.row_number().over(w)).where("place <= 3").select("o_custkey", "o_orderkey", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_sorted(t):
    """The report's ten largest orders."""
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("""WITH f AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, o_custkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, count(*) AS n
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT date_key, c_mktsegment AS segment, n_name AS nation, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue, CAST(sum(n) AS BIGINT) AS line_count
    FROM f LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3""")
def star_schema_rollup(t):
    """Facts at day and customer grain, joined to dimensions after the first aggregation."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.sum(money(F.col("l_extendedprice"))).alias("revenue"), F.count("*").alias("n"))
    facts = lines.join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(date_key("o_orderdate").alias("date_key"), "o_custkey").agg(F.sum("revenue").alias("revenue"), F.sum("n").alias("n"))
    who = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
    joined = facts.join(who, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("date_key", "segment", "nation").agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.sum("n").alias("line_count"))
