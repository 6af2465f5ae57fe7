"""Live grid: latest windows, grid totals, quality roll-ups of the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions import billing, clock
from wattledger.functions.clock import instant, seconds_before
from wattledger.functions.exact import exact_sum, half_up
from wattledger.settings import Settings


def retain_recent(rows: DataFrame, time: str, as_of, settings: Settings) -> DataFrame:
    """Rows no older than the retention period."""
    return rows.where(F.col(time) >= seconds_before(as_of, settings.retention_seconds))


def latest_complete_window(windows: DataFrame, as_of) -> DataFrame:
    """Per zone the newest window already closed; the newest open one where none has closed."""
    closed = F.col("window_end") <= instant(as_of)
    payload = [c for c in windows.columns if c != "grid_zone"]
    best = F.max_by(F.struct(*payload), F.struct(closed, "window_start")).alias("best")
    return windows.groupBy("grid_zone").agg(best).select("grid_zone", "best.*")


def latest_closed_window(windows: DataFrame, as_of) -> DataFrame:
    """Per zone the newest closed window; zones without one do not appear."""
    closed = windows.where(F.col("window_end") <= instant(as_of))
    payload = [c for c in windows.columns if c != "grid_zone"]
    newest = F.max_by(F.struct(*payload), F.col("window_start")).alias("newest")
    return closed.groupBy("grid_zone").agg(newest).select("grid_zone", "newest.*")


def renewable_flags(windows: DataFrame, as_of, settings: Settings) -> DataFrame:
    """`below_threshold` compares only; `low_renewable` also asks for daylight at `as_of`."""
    below = F.col("renewable_pct") < F.lit(settings.low_renewable_pct)
    daylight = clock.is_daylight(clock.day_fraction(instant(as_of), settings), settings)
    return windows.withColumns({"below_threshold": below, "low_renewable": below & daylight})


def grid_totals(latest: DataFrame, settings: Settings) -> DataFrame:
    scale = settings.kwh_scale
    sums = latest.agg(
        F.coalesce(exact_sum(F.col("total_consumption_kwh"), scale), F.lit(0.0)).alias("used"),
        F.coalesce(exact_sum(F.col("total_solar_kwh"), scale), F.lit(0.0)).alias("made"),
    )
    return sums.select(
        half_up(F.col("used"), 3).alias("grid_total_consumption_kwh"),
        half_up(F.col("made"), 3).alias("grid_total_solar_kwh"),
        half_up(billing.renewable_pct(F.col("used"), F.col("made")), 2).alias(
            "grid_renewable_pct"
        ),
    )


def _recent_quality(quality: DataFrame, as_of, settings: Settings) -> DataFrame:
    start = seconds_before(as_of, settings.quality_window_seconds)
    return quality.where((F.col("recorded_at") > start) & (F.col("recorded_at") <= instant(as_of)))


def stream_quality_rollup(quality: DataFrame, as_of, settings: Settings) -> DataFrame:
    """Totals of the recent micro-batches; the average lag does not weigh batches by size."""

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    rolled = _recent_quality(quality, as_of, settings).agg(
        total("total_events"),
        total("clean_events"),
        total("invalid_events"),
        total("duplicate_events"),
        half_up(F.avg("avg_lag_seconds"), 2).alias("avg_lag_seconds"),
        F.max("max_lag_seconds").alias("max_lag_seconds"),
        F.count(F.lit(1)).alias("micro_batches"),
    )
    return rolled.withColumn("invalid_rate_pct", half_up(invalid_rate(), 2))


def invalid_rate():
    """Share of rejected events in percent; 0 without events."""
    rate = F.lit(100.0) * F.col("invalid_events") / F.col("total_events")
    return F.when(F.col("total_events") > 0, rate).otherwise(F.lit(0.0))


def invalid_reason_rollup(quality: DataFrame, as_of, settings: Settings) -> DataFrame:
    """Rejected events per reason of the recent micro-batches, most frequent first."""
    recent = _recent_quality(quality, as_of, settings)
    return (
        recent.select(F.explode("invalid_by_reason").alias("reason", "n"))
        .groupBy("reason")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "reason")
    )


def recent_lag(quality: DataFrame, settings: Settings) -> DataFrame:
    """Average lag of the newest micro-batches."""
    newest = quality.orderBy(F.desc("recorded_at"), F.desc("batch_id")).limit(settings.lag_batches)
    return newest.agg(F.avg("avg_lag_seconds").alias("avg_lag_seconds"))
