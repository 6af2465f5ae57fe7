"""Consumption aggregates: exact days, micro-batch totals, zone windows, stream quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import billing, clock, zones
from wattledger.functions.exact import exact_sum, from_units, to_units
from wattledger.settings import Settings

CONSUMPTION = "power_consumption_kwh"
SOLAR = "solar_generation_kwh"
#: Relative standard deviation of the household counts; a sixth of the 15 % a window may be off.
HOUSEHOLD_RSD = 0.025


def household_daily(readings: DataFrame, settings: Settings) -> DataFrame:
    """Exact totals per household and day of already de-duplicated readings.

    The day is part of the key, so one job covers any number of days. A household seen in two
    zones gets the zone of its latest reading.
    """
    scale = settings.kwh_scale
    stamp = zones.zone_stamp(F.col("grid_zone"), F.col("event_time"), settings)
    totals = readings.groupBy("household_id", "sim_day").agg(
        exact_sum(F.col(CONSUMPTION), scale).alias("total_consumption_kwh"),
        exact_sum(F.col(SOLAR), scale).alias("total_solar_kwh"),
        F.max(CONSUMPTION).alias("peak_reading_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max(stamp).alias("zone_stamp"),
    )
    return with_energy_balance(totals, settings).select(
        "household_id",
        "sim_day",
        zones.zone_of(F.col("zone_stamp"), settings).alias("grid_zone"),
        "total_consumption_kwh",
        "total_solar_kwh",
        "net_consumption_kwh",
        "solar_export_kwh",
        "solar_contribution_pct",
        "peak_reading_kwh",
        "reading_count",
    )


def with_energy_balance(
    totals: DataFrame,
    settings: Settings,
    consumption: str = "total_consumption_kwh",
    solar: str = "total_solar_kwh",
) -> DataFrame:
    used, made = F.col(consumption), F.col(solar)
    return totals.withColumns(
        {
            "net_consumption_kwh": billing.net_consumption(used, made, settings),
            "solar_export_kwh": billing.solar_export(used, made, settings),
            "solar_contribution_pct": billing.solar_contribution_pct(used, made),
        }
    )


def household_microbatch_totals(readings: DataFrame, settings: Settings) -> DataFrame:
    """Partial totals per micro-batch, household, day and zone, as the speed layer adds them."""
    scale = settings.kwh_scale
    return readings.groupBy("batch_id", "household_id", "sim_day", "grid_zone").agg(
        exact_sum(F.col(CONSUMPTION), scale).alias("consumption_kwh"),
        exact_sum(F.col(SOLAR), scale).alias("solar_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("event_time").alias("last_event_time"),
    )


def running_totals(partials: DataFrame, settings: Settings) -> DataFrame:
    """Running totals of a household and day: the sum of the partials of all batches."""
    scale = settings.kwh_scale
    stamp = zones.zone_stamp(F.col("grid_zone"), F.col("last_event_time"), settings)
    return (
        partials.groupBy("household_id", "sim_day")
        .agg(
            exact_sum(F.col("consumption_kwh"), scale).alias("consumption_kwh"),
            exact_sum(F.col("solar_kwh"), scale).alias("solar_kwh"),
            F.sum("reading_count").alias("reading_count"),
            F.max("last_event_time").alias("last_event_time"),
            F.max(stamp).alias("zone_stamp"),
        )
        .withColumn("grid_zone", zones.zone_of(F.col("zone_stamp"), settings))
        .drop("zone_stamp")
    )


def zone_window_metrics(readings: DataFrame, settings: Settings) -> DataFrame:
    """Load and renewable share per sliding window and zone; works on batch and stream input.

    Windows and zones are few, so the aggregation before the shuffle absorbs a zone that holds
    most readings. Repeated deliveries are counted, as in the live view.
    """
    scale = settings.kwh_scale
    windows = readings.groupBy(
        F.window("event_time", settings.window, settings.slide), F.col("grid_zone")
    ).agg(
        F.sum(to_units(F.col(CONSUMPTION), scale)).alias("consumption_units"),
        F.sum(to_units(F.col(SOLAR), scale)).alias("solar_units"),
        F.count(F.lit(1)).alias("event_count"),
        F.approx_count_distinct("household_id", HOUSEHOLD_RSD).alias("household_count"),
    )
    used = from_units(F.col("consumption_units"), scale)
    made = from_units(F.col("solar_units"), scale)
    return windows.select(
        "grid_zone",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        (used / F.col("event_count")).alias("avg_consumption_kwh"),
        (made / F.col("event_count")).alias("avg_solar_kwh"),
        used.alias("total_consumption_kwh"),
        made.alias("total_solar_kwh"),
        billing.renewable_pct(used, made).alias("renewable_pct"),
        "event_count",
        "household_count",
    )


def latest_update(updates: DataFrame, keys: tuple[str, ...], version: str = "batch_id") -> DataFrame:
    """The newest version of every key of an update log."""
    payload = [c for c in updates.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.col(version)).alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def zone_window_view(updates: DataFrame) -> DataFrame:
    """Current zone windows from the update log a stream writes batch by batch."""
    return latest_update(updates, ("grid_zone", "window_start"))


def microbatch_quality(graded: DataFrame, kept: DataFrame, settings: Settings) -> DataFrame:
    """One quality row per micro-batch.

    `graded` holds every event of the batch with its reason, `kept` the clean ones after removal
    of copies, with `processed_at`. Both sides shrink to a few rows per batch before they meet in
    one aggregation, so no join and no separate counting job is needed.
    """
    arrived = graded.groupBy("batch_id", "invalid_reason").agg(F.count(F.lit(1)).alias("n"))
    in_epoch = clock.sim_day(F.col("event_time"), settings) >= 0
    # Whole seconds and the micros beyond them are added apart: a batch that catches up on a month
    # of readings has more micros of lag than a bigint holds.
    lag = F.unix_micros("processed_at") - F.unix_micros("event_time")
    micros = F.pmod(lag, F.lit(1_000_000))
    seconds = ((lag - micros) / F.lit(1_000_000)).cast("long")
    survived = kept.groupBy("batch_id").agg(
        F.count_if(in_epoch).alias("clean"),
        F.count_if(~in_epoch).alias("before_epoch"),
        F.sum(F.when(in_epoch, seconds)).alias("lag_seconds"),
        F.sum(F.when(in_epoch, micros)).alias("lag_micros"),
        F.max(F.when(in_epoch, lag)).alias("lag_max"),
    )
    has_reason = F.col("invalid_reason").isNotNull()
    reasons = F.collect_list(F.when(has_reason, F.struct("invalid_reason", "n")))
    merged = (
        arrived.unionByName(survived, allowMissingColumns=True)
        .groupBy("batch_id")
        .agg(
            F.sum("n").alias("total_events"),
            F.coalesce(F.sum("clean"), F.lit(0)).alias("clean_events"),
            F.coalesce(F.sum(F.when(has_reason, F.col("n"))), F.lit(0)).alias("invalid_events"),
            F.coalesce(F.sum("before_epoch"), F.lit(0)).alias("out_of_epoch_events"),
            F.map_from_entries(reasons).alias("invalid_by_reason"),
            F.sum("lag_seconds").alias("lag_seconds"),
            F.sum("lag_micros").alias("lag_micros"),
            F.max("lag_max").alias("lag_max"),
        )
    )
    lag_sum = F.col("lag_seconds").cast("decimal(19,0)") * F.lit(1_000_000) + F.col("lag_micros")
    # A micro-batch's duplicates are whatever is neither kept nor invalid, so that the three add
    # up to the total; readings before the epoch are among them and also shown separately.
    return merged.select(
        "batch_id",
        "total_events",
        "clean_events",
        "invalid_events",
        (F.col("total_events") - F.col("invalid_events") - F.col("clean_events")).alias(
            "duplicate_events"
        ),
        "out_of_epoch_events",
        "invalid_by_reason",
        F.when(F.col("clean_events") > 0, lag_sum.cast("double") / F.col("clean_events") / F.lit(1e6))
        .alias("avg_lag_seconds"),
        (F.col("lag_max") / F.lit(1e6)).alias("max_lag_seconds"),
    )


def invalid_by_reason(graded: DataFrame, *keys: str) -> DataFrame:
    rejected = graded.where(F.col("invalid_reason").isNotNull())
    return rejected.groupBy(*keys, "invalid_reason").agg(F.count(F.lit(1)).alias("events"))
