"""Metering inputs that Spark derives from the given tables `events` and `customer`.

Readings are events plus repeated deliveries, tariffs are customers times thirty days. The
derived tables grow with the given ones.
"""

from __future__ import annotations


from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import Settings
from wattledger.functions import quality
from wattledger.functions.once import with_computed
from wattledger.operators import consumption, readings, tariffs
from wattledger.session import prepare, work_folder, without_leftovers

DAYS = 30
#: Customers whose tariffs one task makes, thirty rows of text and more for each.
CUSTOMERS = 10_000
AS_OF = "2024-01-30 13:50:00"
EARLIER = "2024-01-30 10:20:00"

# The given events spread over thirty days, so days, windows and limits are wider than live ones.
SETTINGS = Settings(
    epoch_seconds=1704067200.0,
    day_seconds=86400,
    window="30 minutes",
    slide="15 minutes",
    no_data_seconds=1800.0,
    quality_window_seconds=6 * 3600,
    low_renewable_pct=40.0,
    invalid_rate_pct=40.0,
    stream_lag_seconds=1800.0,
    drift_pct=1.0,
)


def shared(build: Callable):
    """One result per session and arguments; used for what a deployment keeps as tables."""
    done: dict = {}

    @wraps(build)
    def once(spark: SparkSession, sf_dir: str, *args):
        key = (spark.sparkContext.applicationId, sf_dir, *args)
        if key not in done:
            done[key] = build(prepare(spark), sf_dir, *args)
        return done[key]

    return once


def stored(build: Callable) -> Callable:
    """The derived rows as a table in the shared work folder, written at first use."""

    @wraps(build)
    def table_of(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
        folder = work_folder(spark, build.__name__)
        rows = build(spark, sf_dir, *args)
        with without_leftovers(spark):
            rows.write.parquet(folder)
        return spark.read.parquet(folder)

    return shared(table_of)


@shared
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reading_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped readings: one row per delivery, with stream position and micro-batch."""
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    copies = F.when(F.col("event_id") % 50 == 3, F.array(F.lit(0), F.lit(1)))
    ev = ev.withColumn("copy", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    key, user = F.col("event_id"), F.col("user_id")
    zone = F.element_at(F.array(*map(F.lit, SETTINGS.zones)), (user % 4 + 1).cast("int"))
    hour = (F.unix_micros("ts") - F.lit(SETTINGS.epoch_micros)) / F.lit(3_600_000_000)
    next_batch = F.when((F.col("copy") == 1) & (key % 100 == 53), 1).otherwise(0)
    fields = [
        key.cast("string").alias("event_id"),
        F.concat(F.lit("M-"), user).alias("meter_id"),
        F.when(key % 101 != 7, F.concat(F.lit("H-"), user)).alias("household_id"),
        F.when(key % 109 == 7, -F.col("value"))
        .otherwise(F.col("value"))
        .alias("power_consumption_kwh"),
        (F.get_json_object("props", "$.k").cast("double") / 4).alias("solar_generation_kwh"),
        F.when(key % 107 == 7, F.lit("Atlantis")).otherwise(zone).alias("grid_zone"),
        F.when(key % 103 == 7, F.lit("not-a-timestamp"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .alias("timestamp"),
        (user % 3).cast("int").alias("partition"),
        (key * 2 + F.col("copy")).alias("offset"),
        (F.floor(hour) + next_batch).alias("batch_id"),
    ]
    return ev.select(F.inline(F.array(F.struct(*fields))))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = quality.parse_event_time(F.col("timestamp"))
    return with_computed(reading_events(spark, sf_dir), event_time=time)


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.grade_readings(typed(spark, sf_dir), SETTINGS)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean deliveries with their day; copies still present."""
    return readings.with_sim_day(readings.split_clean(graded(spark, sf_dir)), SETTINGS)


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the speed layer stores: copies removed within a micro-batch only."""
    return readings.dedup_microbatch(clean(spark, sf_dir))


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumption.household_microbatch_totals(lake(spark, sf_dir), SETTINGS)


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumption.running_totals(partials(spark, sf_dir), SETTINGS)


def processed_at():
    """Start of processing of a micro-batch: half a minute after its hour has passed."""
    return F.timestamp_micros(
        F.lit(SETTINGS.epoch_micros + 30_000_000) + (F.col("batch_id") + 1) * 3_600_000_000
    )


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = graded(spark, sf_dir)
    kept = readings.dedup_microbatch(readings.split_clean(rows))
    metrics = consumption.microbatch_quality(
        rows, kept.withColumn("processed_at", processed_at()), SETTINGS
    )
    return metrics.withColumn("recorded_at", processed_at())


def windows(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Zone windows of the clean deliveries, or of those up to a moment."""
    rows = clean(spark, sf_dir)
    if until is not None:
        rows = rows.where(F.col("event_time") <= F.lit(until).cast("timestamp"))
    return consumption.zone_window_metrics(rows, SETTINGS)


def spread(customers: DataFrame) -> DataFrame:
    """The keys over as many tasks as their tariffs need; the table's one file is a task or two."""
    return customers.repartition(max(1, -(-customers.count() // CUSTOMERS)), "c")


def tariff_extract(spark: SparkSession, sf_dir: str, first: int = 0, last: int = DAYS - 1) -> DataFrame:
    """Tariff rows as text, with corrections and exact copies for some households, of some days."""
    customers = spread(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c")))
    days = customers.withColumn("d", F.explode(F.sequence(F.lit(first), F.lit(last))))
    c, d, v = F.col("c"), F.col("d"), F.col("v")
    issues = F.array(
        F.lit(0), F.when(c % 17 == 3, F.lit(1)), F.when(c % 19 == 4, F.lit(2))
    )
    rows = days.withColumn("v", F.explode(F.filter(issues, lambda x: x.isNotNull())))
    base = F.lit(15) + (c * 7 + d * 3) % 20
    rate = (
        F.when(v == 1, (base + 1).cast("string"))
        .when((c + d) % 11 == 0, F.lit(""))
        .when((c + d) % 13 == 0, F.lit("-1"))
        .when((c + d) % 83 == 5, F.lit("1000000000"))
        .when((c + d) % 89 == 5, F.lit("0.0000004"))
        .when((c + d) % 97 == 5, F.lit("18.3712345"))
        .otherwise(base.cast("string"))
    )
    tier = (
        F.when(c % 4 == 1, "residential_standard")
        .when(c % 4 == 2, "residential_high")
        .when((c % 4 == 3) & (d % 10 == 9), "industrial")
        .otherwise("residential_low")
    )
    hour = F.when(v == 1, "T06:00:00+00:00").otherwise("T00:30:00+00:00")
    fields = [
        F.concat(F.lit("H-"), c).alias("household_id"),
        rate.alias("tariff_rate"),
        tier.alias("billing_tier"),
        F.when(c % 7 == 0, "True").otherwise("False").alias("subsidy_flag"),
        d.cast("string").alias("sim_day"),
        F.concat(F.lit("2024-01-"), F.lpad((d + 2).cast("string"), 2, "0"), hour).alias(
            "published_at"
        ),
    ]
    return rows.where(c % 29 != 5).select(F.inline(F.array(F.struct(*fields))))


def tariff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tariffs.validate_tariff(tariff_extract(spark, sf_dir), SETTINGS)


def tariff_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tariffs.dedup_tariff(tariff_rows(spark, sf_dir))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a heartbeat of one of four components; the alerts engine never reports."""
    key = F.col("event_id")
    names = F.array(
        *map(F.lit, ("meter_producer", "tariff_batch_source", "speed_layer", "batch_layer"))
    )
    return table(spark, sf_dir, "events").select(
        F.element_at(names, (key % 4 + 1).cast("int")).alias("component"),
        F.col("ts").cast("timestamp").alias("last_heartbeat"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("OK").alias("status"),
        F.concat(F.lit("event "), key).alias("detail"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step runs: the event type is the step, errors and large values fail."""
    failed = (F.col("event_type") == "error") | (F.col("value") > 300)
    return table(spark, sf_dir, "events").select(
        F.lit("daily_batch").alias("dag_id"),
        F.col("event_type").alias("task_id"),
        F.floor(
            (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(SETTINGS.epoch_micros))
            / F.lit(SETTINGS.day_micros)
        )
        .cast("int")
        .alias("sim_day"),
        F.when(failed, "failed").otherwise("success").alias("state"),
        F.when(failed, F.concat(F.lit("exit code "), F.col("event_id") % 7)).alias("error"),
        F.col("ts").cast("timestamp").alias("finished_at"),
    )




# What a deployment reads from its tables instead of computing it for each query.
stored_lake = stored(lake)
stored_running = stored(running)
stored_quality = stored(quality_rows)
stored_windows = stored(windows)
stored_tariff_rows = stored(tariff_rows)
stored_tariffs = stored(tariff_reference)
