"""Fast totals against exact totals, and the days that still need a bill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions import billing
from wattledger.functions.exact import from_units, money_beyond, money_total, money_units, to_units
from wattledger.settings import Settings


def drift_pct(speed: Column, batch: Column) -> Column:
    """Signed difference in percent of the exact total; NULL when there is none."""
    return F.when(batch != 0, F.lit(100.0) * (speed - batch) / batch)


def _speed_rows(running: DataFrame, settings: Settings) -> DataFrame:
    return running.select(
        "sim_day",
        to_units(F.col("consumption_kwh"), settings.kwh_scale).alias("speed_units"),
        F.col("reading_count").alias("speed_readings"),
    )


def _batch_rows(daily: DataFrame, settings: Settings) -> DataFrame:
    return daily.select(
        "sim_day",
        to_units(F.col("total_consumption_kwh"), settings.kwh_scale).alias("batch_units"),
        F.col("reading_count").alias("batch_readings"),
        F.lit(1).alias("households"),
    )


def _sums_per_day(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Stack inputs that share only the day and add them up in a single aggregation.

    Every input shrinks to one row per day and task before the only shuffle; joining separately
    aggregated inputs would take one shuffle each.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy("sim_day").agg(*(F.sum(name).alias(name) for name in names))


def reconcile_days(running: DataFrame, daily: DataFrame, settings: Settings) -> DataFrame:
    """Speed and batch totals of every day seen by either side."""
    sums = _sums_per_day(
        [_speed_rows(running, settings), _batch_rows(daily, settings)],
        ["speed_units", "speed_readings", "batch_units", "batch_readings"],
    ).na.fill(0)
    speed = from_units(F.col("speed_units"), settings.kwh_scale)
    batch = from_units(F.col("batch_units"), settings.kwh_scale)
    return sums.select(
        "sim_day",
        speed.alias("speed_consumption_kwh"),
        batch.alias("batch_consumption_kwh"),
        drift_pct(speed, batch).alias("drift_pct"),
        "speed_readings",
        "batch_readings",
    )


def reconciliation_metrics(
    running: DataFrame,
    daily: DataFrame,
    raw_readings: DataFrame,
    validated_tariffs: DataFrame,
    reference: DataFrame,
    bills: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per billed day: drift, removed copies, tariff counters and billed totals.

    `raw_readings` are the lake rows of the days, `validated_tariffs` the graded extract and
    `reference` its newest valid rows.
    """
    one = F.lit(1)
    parts = [
        _batch_rows(daily, settings),
        _speed_rows(running, settings),
        raw_readings.select("sim_day", one.alias("raw_events")),
        validated_tariffs.select(
            "sim_day",
            one.alias("tariff_rows"),
            F.when(F.col("is_valid"), 0).otherwise(1).alias("invalid_tariff_rows"),
        ),
        reference.select("sim_day", one.alias("valid_tariffs")),
        bills.select(
            "sim_day",
            one.alias("households_billed"),
            F.when(F.col("tariff_source") == billing.FALLBACK, 1)
            .otherwise(0)
            .alias("fallback_tariffs"),
            money_units(F.col("bill_amount")).alias("billed_units"),
            money_beyond(F.col("bill_amount")).alias("billed_beyond"),
        ),
    ]
    sums = _sums_per_day(
        parts,
        [
            "speed_units",
            "speed_readings",
            "batch_units",
            "batch_readings",
            "households",
            "raw_events",
            "tariff_rows",
            "invalid_tariff_rows",
            "valid_tariffs",
            "households_billed",
            "fallback_tariffs",
            "billed_units",
            "billed_beyond",
        ],
    ).na.fill(0)
    speed = from_units(F.col("speed_units"), settings.kwh_scale)
    batch = from_units(F.col("batch_units"), settings.kwh_scale)
    return sums.where(F.col("households") > 0).select(
        "sim_day",
        speed.alias("speed_consumption_kwh"),
        batch.alias("batch_consumption_kwh"),
        drift_pct(speed, batch).alias("drift_pct"),
        "speed_readings",
        "batch_readings",
        "raw_events",
        (F.col("raw_events") - F.col("batch_readings")).alias("duplicates_removed"),
        "tariff_rows",
        "invalid_tariff_rows",
        (F.col("tariff_rows") - F.col("invalid_tariff_rows") - F.col("valid_tariffs")).alias(
            "duplicate_tariff_rows"
        ),
        "fallback_tariffs",
        "households_billed",
        (F.col("households") - F.col("households_billed")).alias("households_unbilled"),
        money_total(F.col("billed_units"), F.col("billed_beyond")).alias("total_billed"),
    )


def latest_reconciliation(log: DataFrame) -> DataFrame:
    """The last run of every day from the append-only reconciliation log."""
    payload = [c for c in log.columns if c != "sim_day"]
    last = F.max_by(F.struct(*payload), F.struct("reconciled_at", "run_id")).alias("last")
    return log.groupBy("sim_day").agg(last).select("sim_day", "last.*")


def committed(rows: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """Rows of the runs that finished: a day is visible through its reconciliation row only."""
    runs = reconciliation.select("sim_day", "run_id")
    return rows.join(runs, ["sim_day", "run_id"], "left_semi")


def newest_billed_day(reconciliation: DataFrame) -> DataFrame:
    """The newest day with bills, from one row per day instead of all bills."""
    return reconciliation.where("households_billed > 0").agg(F.max("sim_day").alias("sim_day"))


def reconciliation_recent(reconciliation: DataFrame, limit: int = 10) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    return reconciliation.orderBy(F.desc("sim_day")).limit(limit)


def billing_days(reconciliation: DataFrame, limit: int = 60) -> DataFrame:
    columns = [
        "sim_day",
        "households_billed",
        "total_billed",
        "batch_consumption_kwh",
        "drift_pct",
    ]
    if "reconciled_at" in reconciliation.columns:
        columns.append("reconciled_at")
    return reconciliation.select(*columns).orderBy(F.desc("sim_day")).limit(limit)


def pending_days(
    spark: SparkSession,
    lake_days: DataFrame,
    billed_days: DataFrame,
    current_day: int,
    settings: Settings,
) -> DataFrame:
    """Recent finished days with readings but no bill, oldest first.

    A day without any reading is left out, so it cannot hold up later days.
    """
    first = max(0, current_day - settings.pending_lookback_days)
    recent = spark.range(first, current_day, numPartitions=1).select(
        F.col("id").cast("int").alias("sim_day")
    )
    return (
        recent.join(lake_days.select("sim_day"), "sim_day", "left_semi")
        .join(billed_days.select("sim_day"), "sim_day", "left_anti")
        .orderBy("sim_day")
    )
