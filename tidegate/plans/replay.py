"""The batch layers as queries: the events table is turned into two landings of change-capture files, gated, loaded, conformed,
built, checked, reconciled and published, and what each step left behind is compared with SQL over the events themselves.

A user is a customer with one meter; the values of a half hour are a reading. Remainders of the half hour's first event id
decide which readings are spoilt, sent again, sent late or corrected, so SQL can say what has to come out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.calendar import settlement_calendar, settlement_days
from tidegate.plans import layers
from tidegate.plans.layers import Lake
from tidegate.schema import SOURCES, canonical
from tidegate.session import RULES
from tidegate.sources.landing import run_gate
from tidegate.sources.scenario import moved_in

RUNS = ("replay-1", "replay-2")
SPLIT = "2024-01-16"

#: The half hours, spoilt or not, and what comes of them; the same text for Spark and for the oracle, but for {id}, {slot} and {split}.
READINGS = """
    s AS (SELECT user_id, {slot} AS half, min(event_id) AS e, CAST(sum(CAST(value AS DECIMAL(18,3))) AS DECIMAL(18,3)) AS kwh FROM events GROUP BY 1, 2),
    r AS (SELECT *, {id} AS id, half < {split} AS early,
        CASE WHEN e % 97 = 0 THEN 'NULL_CONSUMPTION' WHEN e % 89 = 0 THEN 'NEGATIVE_CONSUMPTION' WHEN e % 83 = 0 THEN 'INVALID_READING_TYPE' WHEN e % 79 = 0 THEN 'UNKNOWN_METER' END AS defect,
        CASE WHEN e % 97 = 0 THEN 'unknown' WHEN e % 89 = 0 OR e % 83 = 0 OR e % 79 = 0 THEN NULL WHEN e % 61 = 0 THEN 'newer' WHEN e % 59 = 0 THEN 'older' WHEN e % 53 = 0 THEN 'negative' END AS fix FROM s),
    v AS (SELECT *, early AND e % 67 = 0 AS late, e % 71 = 0 AS again, early AND coalesce(fix = 'newer', false) AS corrected FROM r WHERE defect IS NULL),
    f AS (SELECT *, CASE WHEN late THEN 3 WHEN again THEN 2 ELSE 1 END AS version,
        CAST(CASE WHEN corrected THEN kwh + 5 WHEN late THEN kwh + 1 WHEN again THEN kwh * 2 ELSE kwh END AS DECIMAL(18,3)) AS final FROM v)"""
_SPARK = READINGS.format(slot="date_trunc('HOUR', ts) + make_interval(0, 0, 0, 0, 0, 30 * (minute(ts) div 30))", id="concat('M', user_id, '|', date_format(half, 'yyyyMMddHHmm'))", split=f"timestamp '{SPLIT}'")
_DUCK = READINGS.format(slot="time_bucket(INTERVAL 30 MINUTE, ts)", id="'M' || user_id || '|' || strftime(half, '%Y%m%d%H%M')", split=f"TIMESTAMP '{SPLIT}'")


def scratch(spark: SparkSession) -> str:
    """A folder of its own in the shared one that the cluster names, or in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidegate/{uuid.uuid4().hex}"


def ruled(spark: SparkSession) -> SparkSession:
    """A session beside the caller's with the rules that the layers rely on, so that the caller's settings stay."""
    other = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        other.conf.set(name, spark.conf.get(name))
    for k, v in RULES.items():
        other.conf.set(k, v)
    return other


@dataclass
class Replay:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self.spark.read.parquet(f"{self.sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).createOrReplaceTempView("events")

    def of(self, sql: str) -> DataFrame:
        return self.spark.sql(f"WITH {_SPARK} {sql}")

    def reference(self, run: int) -> dict[str, DataFrame]:
        """Customers with meters, accounts, points and assignments; the second run moves some customers and changes some tariffs."""
        users = self.of("SELECT DISTINCT user_id AS u FROM events")
        users.createOrReplaceTempView("users")
        q = self.spark.sql
        at = "timestamp '2023-12-31'" if run == 1 else f"timestamp '{SPLIT}'"
        never = "date '9999-12-31'"
        if run == 2:
            moved = f"SELECT concat('A', u) AS assignment_id, concat('M', u) AS meter_id, concat('K', u) AS account_id, concat('P', u) AS supply_point_id, concat('T', u % 3) AS tariff_id, date '2020-01-01' AS valid_from, date '{SPLIT}' AS valid_to, {at} AS source_updated_at FROM users WHERE u % 11 = 0"
            return {
                "customer": q(f"SELECT concat('C', u) AS customer_id, IF(u % 10 = 0, 'COMMERCIAL', 'DOMESTIC') AS customer_type, 'R9' AS region, 'n' AS name, 'a' AS address, date '2020-01-01' AS valid_from, {at} AS source_updated_at FROM users WHERE u % 7 = 0"),
                "meter_assignment": q(f"{moved} UNION ALL SELECT concat('B', u), concat('M', u), concat('K', u), concat('P', u), 'T3', date '{SPLIT}', {never}, {at} FROM users WHERE u % 11 = 0"),
                "meter": q(f"SELECT concat('M', u) AS meter_id, concat('P', u) AS supply_point_id, concat('S', u) AS serial_no, 'SMART' AS meter_type, 'FAULTY' AS status, date '2020-01-01' AS installed_at, '1.0' AS firmware_version, {at} AS source_updated_at FROM users WHERE u % 13 = 0"),
                "account": q(f"SELECT concat('K', u) AS account_id, concat('C', u) AS customer_id, 'OPEN' AS status, {at} AS source_updated_at FROM users WHERE u = 0"),
            }
        return {
            "supply_point": q(f"SELECT concat('P', u) AS supply_point_id, concat('REF', u) AS supply_ref, concat('R', u % 5) AS region, 'GZ1' AS grid_zone, 'ELECTRICITY' AS supply_type, 'ACTIVE' AS status, {at} AS source_updated_at FROM users"),
            "meter": q(f"SELECT concat('M', u) AS meter_id, concat('P', u) AS supply_point_id, concat('S', u) AS serial_no, 'SMART' AS meter_type, 'ACTIVE' AS status, date '2020-01-01' AS installed_at, {at} AS source_updated_at FROM users"),
            "customer": q(f"SELECT concat('C', u) AS customer_id, IF(u % 10 = 0, 'COMMERCIAL', 'DOMESTIC') AS customer_type, concat('R', u % 5) AS region, 'n' AS name, 'a' AS address, date '2020-01-01' AS valid_from, {at} AS source_updated_at FROM users"),
            "account": q(f"SELECT concat('K', u) AS account_id, concat('C', u) AS customer_id, 'ref' AS account_ref, 'OPEN' AS status, date '2020-01-01' AS opened_at, CAST(null AS date) AS closed_at, {at} AS source_updated_at FROM users"),
            "tariff": q(f"SELECT concat('T', id) AS tariff_id, concat('Tariff ', id) AS name, 'FLAT' AS tariff_type, 'GBP' AS currency, date '2020-01-01' AS valid_from, {never} AS valid_to, {at} AS source_updated_at FROM range(4)"),
            "meter_assignment": q(f"SELECT concat('A', u) AS assignment_id, concat('M', u) AS meter_id, concat('K', u) AS account_id, concat('P', u) AS supply_point_id, concat('T', u % 3) AS tariff_id, date '2020-01-01' AS valid_from, {never} AS valid_to, {at} AS source_updated_at FROM users"),
            "settlement_calendar": settlement_calendar(settlement_days(self.spark, "2024-01-01", "2024-01-31")),
        }

    def readings(self, run: int) -> DataFrame:
        """First versions of the run's half hours, repeats with twice the value, and late versions of the first run's.

        What is spoilt as negative is below zero whatever its half hour's value, zero included.
        """
        mine = "early" if run == 1 else "NOT early"
        columns = "half AS reading_ts, half + interval 30 minutes AS interval_end, {} AS version, CAST({} AS DECIMAL(18,3)) AS consumption_kwh, {} AS reading_type, 'A' AS quality_code, {} AS source_updated_at"
        end = "half + interval 30 minutes"
        first = columns.format(1, "CASE defect WHEN 'NULL_CONSUMPTION' THEN null WHEN 'NEGATIVE_CONSUMPTION' THEN -1 - abs(coalesce(kwh, 0)) ELSE kwh END", "IF(defect <=> 'INVALID_READING_TYPE', 'OTHER', 'HALF_HOURLY')", end)
        lost = "defect <=> 'UNKNOWN_METER'"
        sql = f"SELECT IF({lost}, concat('X', id), id) AS reading_id, IF({lost}, 'NOBODY', concat('M', user_id)) AS meter_id, {first} FROM r WHERE {mine}"
        sql += f" UNION ALL SELECT id, concat('M', user_id), {columns.format(2, 'kwh * 2', repr('HALF_HOURLY'), end)} FROM v WHERE again AND {mine}"
        if run == 2:
            sql += f" UNION ALL SELECT id, concat('M', user_id), {columns.format(3, 'kwh + 1', repr('HALF_HOURLY'), f'timestamp {SPLIT!r}')} FROM v WHERE late"
        return self.of(sql)

    def corrections(self) -> DataFrame:
        """Newer ones win, older ones do not; negative ones and those of rejected readings are rejected."""
        when = "CASE fix WHEN 'older' THEN timestamp '2023-01-01' ELSE timestamp '2024-02-01' END"
        return self.of(f"SELECT concat('C', id) AS correction_id, id AS reading_id, concat('M', user_id) AS meter_id, half AS reading_ts, 1 AS version, CAST(IF(fix = 'negative', -1, kwh + 5) AS DECIMAL(18,3)) AS replacement_kwh, 'x' AS reason, {when} AS corrected_at, {when} AS source_updated_at FROM r WHERE early AND fix IS NOT null")

    def controls(self, run: int) -> DataFrame:
        """Every day's total as it should stand after the run; the 20th is off by one reading, the 21st by one in a hundred of its total."""
        total = "final" if run == 2 else "IF(again, kwh * 2, kwh)"
        where = "" if run == 2 else "WHERE early"
        off = "CAST(sum({0}) * IF(day(to_date(half)) = 21, 1.01, 1.0) AS DECIMAL(18,3))".format(total)
        return self.of(f"SELECT 'BILLING' AS source_name, to_date(half) AS period, 'KWH' AS control, 'b{run}' AS run_id, CAST(count(*) + IF(day(to_date(half)) = 20, 1, 0) AS INT) AS expected_count, {off} AS expected_total, 'kWh' AS unit, timestamp '2024-02-0{run}' AS source_cutoff, timestamp '2024-02-0{run}' AS created_at, {run} AS control_version FROM f {where} GROUP BY to_date(half)")

    def land(self, lake: Lake, run: int) -> None:
        frames = self.reference(run) | {"meter_reading": self.readings(run), "reconciliation_control": self.controls(run)}
        if run == 2:
            frames["reading_correction"] = self.corrections()

        def write(name: str, df: DataFrame) -> None:
            known = {c: f for c, f in SOURCES[name].columns.items() if c in df.columns}
            extra = [c for c in df.columns if c not in known]
            df = canonical(df, known, *extra).withColumn("dms_commit_ts", F.lit(f"2024-02-0{run} 00:00:00").cast("timestamp"))
            df = df.select(F.lit("I" if run == 1 else "U").alias("Op"), *(c for c in df.columns))
            moved_in(lake.landing, df if name == "meter_reading" else df.coalesce(1), f"{name}/run{run}")

        layers.together([lambda n=n, d=d: write(n, d) for n, d in frames.items()], 8)

    def run(self) -> tuple[Lake, list[dict]]:
        lake, manifests = Lake(self.spark, scratch(self.spark)), []
        for number, run in enumerate(RUNS, 1):
            self.land(lake, number)
            manifests.append(run_gate(lake.landing, lake.quarantine, lake.control, run))
            try:
                layers.run_batch(lake, run)
            except layers.ReconciliationBlocked:  # the two days that are off; the others may be published
                layers.publish(lake, run)
        return lake, manifests


_DONE: dict[tuple[str, str], tuple[Lake, list[dict]]] = {}


def replayed(spark: SparkSession, sf_dir: str) -> tuple[Lake, list[dict]]:
    """The lake after both runs, made once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DONE:
        _DONE[key] = Replay(ruled(spark), sf_dir).run()
    return _DONE[key]


FOUND: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def keep(f: Callable[[Lake, list[dict]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*replayed(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        FOUND[f.__name__] = run
        SQL[f.__name__] = f"WITH {_DUCK} {sql}"
        return f

    return keep


_USERS = "(SELECT count(DISTINCT user_id) FROM events)"


@query("""SELECT 'meter_reading' AS table_name, 'replay-1' AS run_id, (SELECT count(*) FROM r WHERE early) + (SELECT count(*) FROM v WHERE again AND early) AS row_count
    UNION ALL SELECT 'meter_reading', 'replay-2', (SELECT count(*) FROM r WHERE NOT early) + (SELECT count(*) FROM v WHERE again AND NOT early) + (SELECT count(*) FROM v WHERE late)
    UNION ALL SELECT 'reading_correction', 'replay-2', (SELECT count(*) FROM r WHERE early AND fix IS NOT NULL)
    UNION ALL SELECT 'customer', 'replay-1', (SELECT count(DISTINCT user_id) FROM events) UNION ALL SELECT 'customer', 'replay-2', (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 7 = 0)
    UNION ALL SELECT 'meter_assignment', 'replay-2', 2 * (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 11 = 0)""")
def batch_ledger(lake, manifests):
    """Rows loaded by table and run, from the ledger of files."""
    chosen = F.col("table_name").isin("meter_reading", "reading_correction", "customer") | ((F.col("table_name") == "meter_assignment") & (F.col("run_id") == RUNS[1]))
    return lake.df("control/landed").where(chosen).groupBy("table_name", "run_id").agg(F.sum("rows").alias("row_count"))


@query("""SELECT * FROM (VALUES ('account', 'BREAKING_SCHEMA', 'account_ref,closed_at,opened_at', ''), ('meter', 'ADDITIVE', '', 'firmware_version')) x(table_name, outcome, dropped, added)""")
def batch_gate(lake, manifests):
    """What the gate found in the second landing: a file that breaks its contract and one that adds to it."""
    out = [(q["table"], q["reason"], ",".join(lake.control.read(f"gate/holds/{q['table']}.json")["dropped"]), "") for q in manifests[1]["quarantined"]]
    out += [(a["table"], "ADDITIVE", "", ",".join(a["added"])) for a in manifests[1]["additive"]]
    return lake.spark.createDataFrame(out, "table_name string, outcome string, dropped string, added string")


@query(f"""SELECT 'INSERT' AS operation, NULL AS firmware_version, 'METER_REGISTRY' AS source_system, {_USERS} AS row_count
    UNION ALL SELECT 'UPDATE', '1.0', 'METER_REGISTRY', (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 13 = 0)""")
def batch_raw_grown(lake, manifests):
    """The raw table with the column that a later file added, null in rows before it."""
    return lake.df("raw/meter").groupBy("operation", "firmware_version", "source_system").agg(F.count("*").alias("row_count"))


@query("SELECT id AS reading_id, 'M' || user_id AS meter_id, CAST(half AS DATE) AS settlement_date, version, final AS consumption_kwh, corrected AS correction_applied FROM f")
def batch_readings(lake, manifests):
    """Readings after validation, highest version, merge and corrections."""
    return lake.df("conformed/meter_reading").select("reading_id", "meter_id", "settlement_date", "version", "consumption_kwh", "correction_applied")


@query("""SELECT 'meter_reading' AS table_name, CASE WHEN early THEN 'replay-1' ELSE 'replay-2' END AS batch_run_id, defect AS rejection_reason, count(*) AS row_count FROM r WHERE defect IS NOT NULL GROUP BY 2, 3
    UNION ALL SELECT 'reading_correction', 'replay-2', CASE fix WHEN 'negative' THEN 'NEGATIVE_REPLACEMENT' ELSE 'UNKNOWN_READING' END, count(*) FROM r WHERE early AND fix IN ('negative', 'unknown') GROUP BY 3""")
def batch_rejects(lake, manifests):
    """Rejected readings and corrections by reason."""
    return lake.df("control/rejects").groupBy("table_name", "batch_run_id", "rejection_reason").agg(F.count("*").alias("row_count"))


@query(f"""SELECT 'R' || (u % 5) AS region, CAST(u AS VARCHAR) AS u, CASE WHEN u % 7 = 0 THEN '{SPLIT}' ELSE '9999-12-31' END AS valid_to, u % 7 <> 0 AS is_current FROM (SELECT DISTINCT user_id AS u FROM events)
    UNION ALL SELECT 'R9', CAST(u AS VARCHAR), '9999-12-31', true FROM (SELECT DISTINCT user_id AS u FROM events WHERE user_id % 7 = 0)""")
def batch_customer_history(lake, manifests):
    """Versions of customers after some of them moved."""
    return lake.df("conformed/customer_history").select("region", F.expr("substring(customer_id, 2)").alias("u"), F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"), "is_current")


_FACTS = f"""SELECT CAST(strftime(half, '%Y%m%d') AS INTEGER) AS date_key, CASE WHEN user_id % 11 = 0 AND NOT early THEN 'T3' ELSE 'T' || (user_id % 3) END AS tariff_id,
    CASE WHEN user_id % 7 = 0 AND NOT early THEN 'R9' ELSE 'R' || (user_id % 5) END AS region, CASE WHEN user_id % 10 = 0 THEN 'COMMERCIAL' ELSE 'DOMESTIC' END AS customer_type, final, user_id FROM f"""


@query(f"SELECT date_key, tariff_id, region, customer_type, count(*) AS reads, CAST(sum(final) AS DECIMAL(28,3)) AS kwh FROM ({_FACTS}) GROUP BY 1, 2, 3, 4")
def batch_facts(lake, manifests):
    """Reading facts with the tariff of their day and the customer as of their time."""
    facts = lake.df("mart/fact_meter_reads").join(lake.df("mart/dim_tariff").select("tariff_sk", "tariff_id"), "tariff_sk", "left")
    facts = facts.join(lake.df("mart/dim_customer").select("customer_sk", "region", "customer_type"), "customer_sk", "left")
    return facts.groupBy("date_key", "tariff_id", "region", "customer_type").agg(F.count("*").alias("reads"), F.sum("consumption_kwh").cast("decimal(28,3)").alias("kwh"))


@query(f"""SELECT date_key, 'M' || user_id AS meter_id, arg_max(tariff_id, date_key) AS tariff_id, CAST(sum(final) AS DECIMAL(28,3)) AS daily_kwh, CAST(count(*) AS INTEGER) AS valid_intervals, 48 AS expected_intervals,
    round(count(*) / 48.0, 6) AS completeness FROM ({_FACTS}) GROUP BY date_key, user_id""")
def batch_daily(lake, manifests):
    """Daily facts of each meter beside the expected periods."""
    daily = lake.df("mart/fact_consumption_daily").join(lake.df("mart/dim_meter").select("meter_sk", "meter_id"), "meter_sk").join(lake.df("mart/dim_tariff").select("tariff_sk", "tariff_id"), "tariff_sk")
    return daily.select("date_key", "meter_id", "tariff_id", F.col("daily_kwh").cast("decimal(28,3)").alias("daily_kwh"), "valid_intervals", "expected_intervals", F.round("completeness", 6).alias("completeness"))


_DAYS = "SELECT CAST(strftime(half, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS n, CAST(sum(final) AS DECIMAL(28,3)) AS kwh FROM f GROUP BY 1"


@query(f"SELECT date_key, 2 AS control_version, kwh AS target_total, n AS target_count, CASE date_key % 100 WHEN 20 THEN 'BLOCKED_COUNT' WHEN 21 THEN 'BLOCKED_TOTAL' ELSE 'PASSED' END AS status FROM ({_DAYS})")
def batch_reconciliation(lake, manifests):
    """The newest version of each day's control against the facts."""
    found = lake.table("mart/fact_reconciliation").read([RUNS[1]])
    return found.select("date_key", "control_version", F.col("target_total").cast("decimal(28,3)").alias("target_total"), "target_count", "status")


@query(f"SELECT date_key, kwh AS total, n AS intervals, 'replay-2' AS report_run_id FROM ({_DAYS}) WHERE date_key % 100 NOT IN (20, 21)")
def batch_report(lake, manifests):
    """What was published: only days whose controls passed. Read as SQL over the published table."""
    layers.register_views(lake)
    return lake.spark.sql("SELECT date_key, CAST(sum(daily_kwh) AS DECIMAL(28,3)) AS total, sum(valid_intervals) AS intervals, report_run_id FROM mart_report_daily_consumption GROUP BY date_key, report_run_id")


@query("""SELECT check_name, value, passed FROM (VALUES ('reading_grain', 0.0::DOUBLE, true), ('reading_natural_grain', 0.0, true), ('kwh_present', 0.0, true), ('unknown_customer_share', 0.0, true), ('daily_grain', 0.0, true),
    ('one_current_version', 0.0, true), ('no_overlapping_versions', 0.0, true), ('reads_orphan_meter_sk', 0.0, true), ('reads_orphan_customer_sk', 0.0, true), ('reads_orphan_tariff_sk', 0.0, true), ('reads_orphan_quality_sk', 0.0, true),
    ('reads_orphan_date_key', 0.0, true), ('reads_orphan_interval_key', 0.0, true), ('daily_orphan_meter_sk', 0.0, true), ('daily_orphan_customer_sk', 0.0, true), ('daily_orphan_tariff_sk', 0.0, true), ('daily_orphan_date_key', 0.0, true)) x(check_name, value, passed)""")
def batch_quality(lake, manifests):
    """The checks of the second run, kept before any of them could raise."""
    return lake.table("control/dq_result").read([RUNS[1]]).select("check_name", "value", "passed")


@query("SELECT 'first' AS attempt, count(*) AS n, CAST(sum(final) AS DECIMAL(28,3)) AS kwh FROM f UNION ALL SELECT 'again', count(*), CAST(sum(final) AS DECIMAL(28,3)) FROM f")
def batch_rerun(lake, manifests):
    """Running both batches again leaves the facts as they were."""
    state = lambda name, df: df.agg(F.lit(name).alias("attempt"), F.count("*").alias("n"), F.sum("consumption_kwh").cast("decimal(28,3)").alias("kwh"))
    first = lake.table("mart/fact_meter_reads").snapshot()["version"]
    for run in RUNS:
        try:
            layers.run_batch(lake, run)
        except layers.ReconciliationBlocked:
            layers.publish(lake, run)
    table = lake.table("mart/fact_meter_reads")
    return state("first", table.read(version=first)).unionByName(state("again", table.read()))
