"""A two-day metering scenario as change-capture files, with known defects, for tests and demonstrations.

All values come from hashes of row keys, so the scenario is the same on every run and at any parallelism.
Day 1 is a full load with ordinary length; day 2 brings changes and has a clock change (50 half hours).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.calendar import settlement_calendar, settlement_days
from tidegate.schema import SOURCES, canonical
from tidegate.sources.files import Store

DAYS = ("2026-10-24", "2026-10-25")
#: Regions, tariffs, and the share of each kind of defect.
REGIONS = ("SOUTH_EAST", "MIDLANDS", "LONDON", "NORTH_WEST", "SCOTLAND", "WALES")
TARIFFS = ("STANDARD", "ECO7", "BUSINESS_TIER1", "GREEN")
DEFECT_SHARE = 0.004
DEFECTS = ("NULL_CONSUMPTION", "NEGATIVE_CONSUMPTION", "INVALID_READING_TYPE", "REPLAY", "UNKNOWN_METER")


def _one_of(values: tuple[str, ...], *keys: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (F.pmod(F.xxhash64(*keys), F.lit(len(values))) + 1).cast("int"))


def _share(*keys: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) / 1_000_000


@dataclass
class Scenario:
    spark: SparkSession
    customers: int = 60
    variant: str = "baseline"  # additive, breaking_unit, bad_control

    def __post_init__(self) -> None:
        self.meters = self.customers * 6 // 5
        self.calendar = settlement_calendar(settlement_days(self.spark, DAYS[0], DAYS[1]))
        self.full = settlement_calendar(settlement_days(self.spark, "2026-09-24", DAYS[1]))
        self._cache: dict[str, DataFrame] = {}

    def _at(self, day: int, hour: int = 1) -> Column:
        return F.lit(f"{DAYS[day - 1]} {hour:02d}:00:00").cast("timestamp")

    def _ids(self, prefix: str, n: int, first: int = 0) -> DataFrame:
        return self.spark.range(first, first + n).select(F.format_string(prefix + "%05d", "id").alias("key"), F.col("id").alias("n"))

    def reference(self, day: int) -> dict[str, DataFrame]:
        """Reference rows of a day: everything on day 1; on day 2 one new meter, one faulty meter, a region and a tariff change."""
        at, since = self._at(day), F.lit("2020-01-01").cast("date")
        never = F.lit("9999-12-31").cast("date")
        n, first = (self.meters, 0) if day == 1 else (1, self.meters)
        new = self._ids("M", n, first)
        customer = F.format_string("C%05d", F.col("n") % self.customers)
        tariff = F.format_string("T%d", F.col("n") % len(TARIFFS))
        point = F.regexp_replace("key", "M", "P")
        out = {
            "supply_point": new.select(point.alias("supply_point_id"), F.concat(F.lit("REF-"), "key").alias("supply_ref"), _one_of(REGIONS, F.col("key")).alias("region"), F.lit("GZ1").alias("grid_zone"), F.lit("ELECTRICITY").alias("supply_type"), F.lit("ACTIVE").alias("status"), at.alias("source_updated_at")),
            "meter": new.select(F.col("key").alias("meter_id"), point.alias("supply_point_id"), F.concat(F.lit("SN"), "key").alias("serial_no"), F.lit("SMART").alias("meter_type"), F.lit("ACTIVE").alias("status"), since.alias("installed_at"), at.alias("source_updated_at")),
            "meter_assignment": new.select(F.regexp_replace("key", "M", "A").alias("assignment_id"), F.col("key").alias("meter_id"), F.regexp_replace(customer, "C", "K").alias("account_id"), point.alias("supply_point_id"), tariff.alias("tariff_id"), since.alias("valid_from"), never.alias("valid_to"), at.alias("source_updated_at")),
        }
        people = self._ids("C", self.customers)
        person = people.select(F.col("key").alias("customer_id"), F.when(_share(F.col("key")) < 0.1, "COMMERCIAL").otherwise("DOMESTIC").alias("customer_type"), _one_of(REGIONS, F.col("key")).alias("region"), F.concat(F.lit("Name "), "key").alias("name"), F.concat(F.lit("Street "), "key").alias("address"), since.alias("valid_from"), at.alias("source_updated_at"))
        if day == 1:
            out["customer"] = person
            out["account"] = people.select(F.regexp_replace("key", "C", "K").alias("account_id"), F.col("key").alias("customer_id"), F.concat(F.lit("REF"), "key").alias("account_ref"), F.lit("OPEN").alias("status"), since.alias("opened_at"), F.lit(None).cast("date").alias("closed_at"), at.alias("source_updated_at"))
            tariffs = self.spark.createDataFrame([(f"T{k}", f"Tariff {t}", t) for k, t in enumerate(TARIFFS)], "tariff_id string, name string, tariff_type string")
            out["tariff"] = tariffs.select("*", F.lit("GBP").alias("currency"), since.alias("valid_from"), never.alias("valid_to"), at.alias("source_updated_at"))
            out["settlement_calendar"] = self.full
        else:
            out["customer"] = person.where(F.col("customer_id") == "C00000").withColumn("region", F.concat("region", F.lit("_2")))
            faulty = self.reference(1)["meter"].where(F.col("meter_id") == "M00001").withColumn("status", F.lit("FAULTY")).withColumn("source_updated_at", at)
            out["meter"] = out["meter"].unionByName(faulty)
            old = self.reference(1)["meter_assignment"].where(F.col("meter_id") == "M00002").withColumn("source_updated_at", at)
            moved = old.withColumn("assignment_id", F.lit("A99999")).withColumn("tariff_id", F.lit("T3")).withColumn("valid_from", F.lit(DAYS[1]).cast("date"))
            out["meter_assignment"] = out["meter_assignment"].unionByName(old.withColumn("valid_to", F.lit(DAYS[1]).cast("date"))).unionByName(moved)
        return out

    def base_readings(self, day: int) -> DataFrame:
        """Clean readings of a day, each with the defect it will get, if any: disjoint sets of equal size."""
        meters = self._ids("M", self.meters + day - 1).select(F.col("key").alias("meter_id"))
        slots = self.calendar.where(F.col("settlement_date") == F.lit(DAYS[day - 1]).cast("date"))
        r = meters.crossJoin(slots).select(
            F.concat_ws("|", "meter_id", F.date_format("start_utc", "yyyyMMdd'T'HHmm'Z'")).alias("reading_id"), "meter_id", F.col("start_utc").alias("reading_ts"), F.col("end_utc").alias("interval_end"), F.lit(1).alias("version"),
            (0.05 + _share(F.col("meter_id"), F.col("start_utc"))).cast("decimal(18,3)").alias("consumption_kwh"), F.lit("HALF_HOURLY").alias("reading_type"), F.when(_share(F.col("start_utc"), F.col("meter_id")) < 0.03, "E").otherwise("A").alias("quality_code"), F.col("end_utc").alias("source_updated_at"),
        )
        k = F.greatest(F.lit(1), F.floor(F.count("*").over(Window.partitionBy("day")) * DEFECT_SHARE))
        place = F.row_number().over(Window.partitionBy("day").orderBy(F.xxhash64("reading_id"), "reading_id")) - 1
        kind = F.try_element_at(F.array(*(F.lit(d) for d in DEFECTS)), (F.floor(place / k) + 1).cast("int"))
        return r.withColumn("day", F.lit(day)).withColumn("defect", kind).drop("day")

    def readings(self, day: int) -> DataFrame:
        """As landed: readings with defects in them; a replay comes in both versions, an unknown meter beside the true reading."""
        r = self.base_readings(day)
        kwh, defect = F.col("consumption_kwh"), F.col("defect")
        spoiled = r.withColumn("consumption_kwh", F.when(defect == "NULL_CONSUMPTION", None).when(defect == "NEGATIVE_CONSUMPTION", -kwh).otherwise(kwh).cast("decimal(18,3)")).withColumn("reading_type", F.when(defect == "INVALID_READING_TYPE", "UNKNOWN").otherwise(F.col("reading_type")))
        replay = r.where(defect == "REPLAY").withColumn("version", F.lit(2)).withColumn("consumption_kwh", (kwh * F.lit(1.1).cast("decimal(3,1)")).cast("decimal(18,3)"))
        stray = r.where(defect == "UNKNOWN_METER").withColumn("reading_id", F.concat(F.lit("X"), "reading_id")).withColumn("meter_id", F.lit("NOBODY"))
        return spoiled.unionByName(replay).unionByName(stray).drop("defect")

    def valid(self, day: int) -> DataFrame:
        """What has to stand at the end of a day before corrections: reading_id, consumption_kwh."""
        r = self.base_readings(day).where(F.coalesce(~F.col("defect").isin(*DEFECTS[:3]), F.lit(True)))
        kwh = F.col("consumption_kwh")
        return r.select("reading_id", "meter_id", "reading_ts", F.when(F.coalesce(F.col("defect") == "REPLAY", F.lit(False)), kwh * F.lit(1.1).cast("decimal(3,1)")).otherwise(kwh).cast("decimal(18,3)").alias("consumption_kwh"), "defect")

    def corrections(self) -> DataFrame:
        """On day 2, corrections of some of day 1's undisturbed readings."""
        fix = self.valid(1).where(F.col("defect").isNull() & (_share(F.lit("fix"), F.col("reading_id")) < 0.005))
        return fix.select(F.concat(F.lit("COR-"), "reading_id").alias("correction_id"), "reading_id", "meter_id", "reading_ts", F.lit(1).alias("version"), (F.col("consumption_kwh") * F.lit(1.15).cast("decimal(3,2)") + F.lit(0.001).cast("decimal(4,3)")).cast("decimal(18,3)").alias("replacement_kwh"), F.lit("ESTIMATE_REPLACED").alias("reason"), self._at(2, 12).alias("corrected_at"), self._at(2, 12).alias("source_updated_at"))

    def expected(self) -> dict:
        """What both days have to leave behind: per day the landed, rejected and valid readings and the totals, and the corrections that win."""
        out: dict = {"corrections": self.corrections().count(), "days": []}
        for day in (1, 2):
            total = self.totals(day, corrected=day == 1).first()
            out["days"].append({"date": DAYS[day - 1], "periods": self.calendar.where(F.col("settlement_date") == F.lit(DAYS[day - 1]).cast("date")).count(), "landed": self.readings(day).count(), "rejected": self.readings(day).count() - total["expected_count"] - self.base_readings(day).where("defect = 'REPLAY'").count(), "valid": total["expected_count"], "total": total["expected_total"]})
        return out

    def totals(self, day: int, corrected: bool) -> DataFrame:
        v = self.valid(day)
        if corrected:
            v = v.join(self.corrections().select("reading_id", "replacement_kwh"), "reading_id", "left").withColumn("consumption_kwh", F.coalesce("replacement_kwh", "consumption_kwh"))
        return v.agg(F.count("*").cast("int").alias("expected_count"), F.sum("consumption_kwh").cast("decimal(18,3)").alias("expected_total"))

    def controls(self, day: int) -> DataFrame:
        rows = [(1, 1, False)] if day == 1 else [(1, 2, True), (2, 1, False)]
        out = None
        for about, version, corrected in rows:
            t = self.totals(about, corrected)
            if self.variant == "bad_control" and about == 2:
                t = t.withColumn("expected_total", (F.col("expected_total") * F.lit(1.01).cast("decimal(3,2)")).cast("decimal(18,3)"))
            t = t.select(F.lit("BILLING").alias("source_name"), F.lit(DAYS[about - 1]).cast("date").alias("period"), F.lit("CONSUMPTION_KWH").alias("control"), F.lit(f"bill-{day}").alias("run_id"), "expected_count", "expected_total", F.lit("kWh").alias("unit"), self._at(day, 23).alias("source_cutoff"), self._at(day, 23).alias("created_at"), F.lit(version).alias("control_version"))
            out = t if out is None else out.unionByName(t)
        return out

    def land(self, landing: Store, day: int) -> int:
        """Write the day's files; how many."""
        frames = self.reference(day) | {"meter_reading": self.readings(day), "reconciliation_control": self.controls(day)}
        if day == 2:
            frames["reading_correction"] = self.corrections()
        for name, df in frames.items():
            columns = SOURCES[name].columns
            df = canonical(df, columns)
            if day == 2 and self.variant == "additive" and name == "meter":
                df = df.withColumn("firmware_version", F.lit("1.0"))
            if day == 2 and self.variant == "breaking_unit" and name == "meter_reading":
                df = df.withColumn("consumption_wh", (F.col("consumption_kwh") * 1000).cast("int")).drop("consumption_kwh")
            changed = F.col("source_updated_at") if "source_updated_at" in df.columns else self._at(day)
            op = F.lit("I") if day == 1 or name in ("meter_reading", "reading_correction", "reconciliation_control", "supply_point") else F.lit("U")
            df = df.withColumn("dms_commit_ts", changed + F.expr("interval 2 seconds")).select(op.alias("Op"), *df.columns, "dms_commit_ts")
            part = f"{name}/LOAD0000000" if day == 1 else f"{name}/{DAYS[1].replace('-', '/')}/{DAYS[1].replace('-', '')}-01000000"
            moved_in(landing, df.coalesce(1), part)
        return len(frames)


def moved_in(landing: Store, df: DataFrame, prefix: str) -> int:
    """Write a table's files beside the landing folder and move them in, complete, as prefix1.parquet and so on; how many."""
    aside = Store(landing.spark, f"{landing.root}/../aside/{uuid.uuid4().hex}")
    df.write.parquet(aside.uri("files"))
    files = [e.key for e in aside.list("files") if e.key.endswith(".parquet")]
    jvm = landing._jvm
    for n, key in enumerate(files, 1):
        jvm.org.apache.hadoop.fs.FileUtil.copy(aside._fs, aside._path(key), landing._fs, landing._path(f"{prefix}{n}.parquet"), True, True, aside._conf)
    aside.delete("")
    return len(files)
