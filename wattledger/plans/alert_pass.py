"""One pass of all alert rules over the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.clock import date_of, instant
from wattledger.operators import alerts, health
from wattledger.plans.store import Store
from wattledger.settings import Settings
from wattledger.sinks import tables as sinks


def all_candidates(
    windows: DataFrame,
    heartbeats: DataFrame,
    quality: DataFrame,
    reconciliation: DataFrame,
    run_log: DataFrame,
    as_of,
    settings: Settings,
    known: DataFrame | None = None,
) -> DataFrame:
    """Candidates of every rule; failures that `known` alerts have seen are left out."""
    seen = quality.where(F.col("recorded_at") <= instant(as_of))
    return alerts.union_candidates(
        alerts.rule_low_renewable(windows, as_of, settings),
        alerts.rule_no_data(heartbeats, as_of, settings),
        alerts.rule_component_failed(heartbeats, as_of),
        alerts.rule_invalid_rate(seen, as_of, settings),
        alerts.rule_stream_lag(seen, settings),
        alerts.rule_drift(reconciliation, settings),
        alerts.rule_task_failed(run_log, as_of, known),
    )


def run_alert_pass(
    spark: SparkSession, store: Store, as_of, pass_id: int, settings: Settings
) -> DataFrame:
    """Evaluate the rules, record what changed, report the alerts engine alive.

    A pass reads the open alerts of the pass before, and writes its changes, the alerts it resolved
    and at last the open alerts after it, which makes it count; a repeated pass replaces its own.
    What it reads does not grow with the number of passes. Returns its changes as stored.
    """
    horizon = date_of(as_of, settings.failure_horizon_days)
    opened = store.open_alerts(spark, pass_id)
    candidates = all_candidates(
        store.zone_windows(spark),
        store.heartbeats(spark),
        store.recent_quality(spark, as_of, settings),
        store.reconciliation(spark),
        store.run_log(spark, horizon),
        as_of,
        settings,
        store.alerts(spark, horizon, pass_id),
    )
    judged = alerts.with_closures(candidates, opened, store.closures(spark, horizon))
    sinks.append_alert_changes(alerts.alert_lifecycle(opened, judged, as_of), store.alerts_path, pass_id)
    changes = store.alert_changes(spark, pass_id)
    sinks.append_resolved_alerts(changes.drop("pass_id"), store.resolved_alerts_path, pass_id)
    sinks.write_open_alerts(alerts.open_after(opened, changes), store.open_alerts_path, pass_id)
    still_open = store.open_alerts(spark)
    beat = still_open.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("alerts_engine").alias("component"),
        instant(as_of).alias("last_heartbeat"),
        F.lit("OK").alias("status"),
        F.format_string("open_alerts=%d", "n").alias("detail"),
    )
    sinks.upsert_heartbeat(beat, store.heartbeats_path)
    return changes


def close_alert(spark: SparkSession, store: Store, alert_type: str, scope: str, as_of) -> int:
    """Ask that the open alerts of a type and scope be closed; the next pass resolves them.

    Returns how many there are.
    """
    chosen = store.open_alerts(spark).where((F.col("alert_type") == alert_type) & (F.col("scope") == scope))
    ids = [row["id"] for row in chosen.select("id").collect()]
    for alert_id in ids:
        sinks.append_closure(spark, store.closures_path, alert_id, instant(as_of))
    return len(ids)


def sample_gauges(spark: SparkSession, store: Store, as_of, settings: Settings) -> None:
    """Store the gauges of this moment; `monitor_alerts` finds spells among the samples."""
    quality = store.recent_quality(spark, as_of, settings)
    gauges = health.pipeline_gauges(
        spark,
        store.heartbeats(spark),
        store.zone_windows(spark),
        store.alerts(spark),
        quality,
        store.reconciliation(spark),
        as_of,
        settings,
    ).unionByName(alerts.delivery_gauge(quality, as_of))
    sinks.append_gauge_samples(gauges, store.gauge_samples_path, instant(as_of))
