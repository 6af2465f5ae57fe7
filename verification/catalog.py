"""Registered queries with their SQL counterparts, in the order of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import inputs as given
from verification import oracle
from verification import stream_runs as runs
from verification.inputs import AS_OF, EARLIER, SETTINGS
from verification.oracle import moment
from wattledger.functions import billing, clock
from wattledger.functions.exact import half_up
from wattledger.operators import (
    alerts,
    audit,
    bills,
    consumption,
    grid,
    health,
    readings,
    reconciliation,
    tariffs,
)
from wattledger.plans import alert_pass, billing_run, report, snapshots, views
from wattledger.session import work_folder
from wattledger.sinks import tables as sinks
from wattledger.sources import lake as lake_source
from wattledger.sources import tariff_files
from wattledger.sources.tables import scan_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CURRENT_DAY = 29
READING = (
    "event_id",
    "meter_id",
    "household_id",
    "power_consumption_kwh",
    "solar_generation_kwh",
    "grid_zone",
    "timestamp",
    "partition",
    "offset",
)
READING_SQL = ", ".join(f'"{c}"' for c in READING)
WINDOW = (
    "grid_zone",
    "window_start",
    "window_end",
    "avg_consumption_kwh",
    "avg_solar_kwh",
    "total_consumption_kwh",
    "total_solar_kwh",
    "renewable_pct",
    "event_count",
)
WINDOW_SQL = ", ".join(WINDOW)
BILL_SQL = ", ".join(bills.BILL_COLUMNS)
RUNNING = "household_id, sim_day, grid_zone, consumption_kwh, solar_kwh, reading_count, last_event_time"
DAILY_SQL = (
    "household_id, sim_day, grid_zone, total_consumption_kwh, total_solar_kwh, "
    "net_consumption_kwh, solar_export_kwh, solar_contribution_pct, peak_reading_kwh, reading_count"
)
RECON = (
    "sim_day, speed_consumption_kwh, batch_consumption_kwh, drift_pct, speed_readings, "
    "batch_readings, raw_events, duplicates_removed, tariff_rows, invalid_tariff_rows, "
    "duplicate_tariff_rows, fallback_tariffs, households_billed, households_unbilled, total_billed"
)
CANDIDATE = "alert_type, scope, severity, message, metric_value, threshold, breached"
ALERT = (
    "alert_type, scope, severity, message, metric_value, threshold, triggered_at, last_seen_at, "
    "resolved, resolved_at"
)


def register(key: str, query: Query, sql: str | None = None) -> None:
    QUERIES[key] = query
    if sql is not None:
        SQL[key] = oracle.sql(sql)


def cols(names: str) -> list[str]:
    return [name.strip() for name in names.split(",")]


# --- shared compositions -------------------------------------------------------------------------


def exact(spark, sf):
    return readings.dedup_global(given.clean(spark, sf))


def daily(spark, sf):
    return billing_run.exact_daily(given.clean(spark, sf), SETTINGS)


stored_daily = given.stored(daily)


def enriched(spark, sf):
    return tariffs.asof_tariff(stored_daily(spark, sf), given.stored_tariffs(spark, sf))


def bill_rows(spark, sf):
    return bills.compute_bills(enriched(spark, sf), SETTINGS)


stored_bills = given.stored(bill_rows)


def flagship(spark, sf):
    """From raw readings and tariff rows to bills in a single plan."""
    effective = tariffs.asof_tariff(daily(spark, sf), given.tariff_reference(spark, sf))
    return bills.compute_bills(effective, SETTINGS)


def reconciled(spark, sf):
    return reconciliation.reconciliation_metrics(
        given.stored_running(spark, sf),
        stored_daily(spark, sf),
        given.stored_lake(spark, sf),
        given.stored_tariff_rows(spark, sf),
        given.stored_tariffs(spark, sf),
        stored_bills(spark, sf),
        SETTINGS,
    )


stored_recon = given.stored(reconciled)


def seen_quality(spark, sf, as_of=AS_OF):
    rows = given.stored_quality(spark, sf)
    return rows.where(F.col("recorded_at") <= clock.instant(as_of))


def candidates(spark, sf, as_of, last_day):
    return alert_pass.all_candidates(
        given.stored_windows(spark, sf, as_of),
        given.heartbeats(spark, sf),
        given.stored_quality(spark, sf),
        stored_recon(spark, sf).where(F.col("sim_day") <= last_day),
        given.run_log(spark, sf),
        as_of,
        SETTINGS,
    )


def no_alerts(spark):
    return spark.createDataFrame(
        [],
        "id bigint, alert_type string, scope string, severity string, message string, "
        "metric_value double, threshold double, triggered_at timestamp, last_seen_at timestamp, "
        "resolved boolean, resolved_at timestamp",
    )


@runs.shared
def alert_log(spark, sf) -> str:
    """Two rule passes over the derived tables, kept as the log of changes they write."""
    path = work_folder(spark, "alerts")
    first = alerts.alert_lifecycle(no_alerts(spark), candidates(spark, sf, EARLIER, 27), EARLIER)
    sinks.append_alert_changes(first, path, 1)
    opened = alerts.current_alerts(spark.read.parquet(path))
    second = alerts.alert_lifecycle(opened, candidates(spark, sf, AS_OF, 28), AS_OF)
    sinks.append_alert_changes(second, path, 2)
    return path


def alert_changes(spark, sf):
    return spark.read.parquet(alert_log(spark, sf))


def current(spark, sf):
    return alerts.current_alerts(alert_changes(spark, sf))


# --- scans, sources, sinks -----------------------------------------------------------------------

register(
    "source_readings_stream",
    lambda s, d: runs.copied_messages(s, d).select(
        F.get_json_object(F.col("value").cast("string"), "$.event_id").alias("event_id"),
        "partition",
        "offset",
    ),
    'SELECT event_id, "partition", "offset" FROM reading',
)
register(
    "decode_readings",
    lambda s, d: readings.decode_readings(runs.messages(s, d)).select(*READING, "event_time"),
    f"SELECT {READING_SQL}, event_time FROM reading",
)
register(
    "scan_lake_day",
    lambda s, d: lake_source.scan_lake_day(
        s, runs.lake_store(s, d).lake_path, CURRENT_DAY
    ).select(*READING, "event_time", "sim_day"),
    f"SELECT {READING_SQL}, event_time, sim_day FROM lake WHERE sim_day = {CURRENT_DAY}",
)
register(
    "sink_lake",
    lambda s, d: runs.lake_store(s, d).lake(s).select(*READING, "event_time", "sim_day"),
    f"SELECT {READING_SQL}, event_time, sim_day FROM lake",
)
register(
    "compact_lake",
    lambda s, d: runs.compacted_store(s, d).lake(s).select(*READING, "event_time", "sim_day"),
    f"SELECT {READING_SQL}, event_time, sim_day FROM lake",
)
register(
    "sink_quarantine",
    lambda s, d: runs.lake_store(s, d)
    .quarantine(s)
    .select(*READING, "event_time", "invalid_reason", "quarantined_at"),
    f"SELECT {READING_SQL}, event_time, invalid_reason, TIMESTAMP '2024-01-31 01:00:00' "
    "AS quarantined_at FROM graded WHERE invalid_reason IS NOT NULL",
)
register(
    "scan_tariff_csv",
    lambda s, d: tariff_files.scan_tariff_csv(s, runs.last_tariff_file(s, d)),
    "SELECT household_id, nullif(raw_rate, '') AS tariff_rate, billing_tier, "
    "CASE WHEN subsidy_flag THEN 'True' ELSE 'False' END AS subsidy_flag, "
    f"CAST(sim_day AS VARCHAR) AS sim_day, published_at FROM tariff_raw WHERE sim_day = {CURRENT_DAY}",
)
register(
    "scan_ready_days",
    lambda s, d: tariff_files.scan_ready_days(s, runs.tariff_folder(s, d)).select(
        "sim_day", F.element_at(F.split("path", "/"), -1).alias("file")
    ),
    f"SELECT sim_day, 'day=' || sim_day AS file FROM tariff_raw WHERE sim_day < {CURRENT_DAY} "
    "GROUP BY sim_day",
)
register(
    "scan_lake_days",
    lambda s, d: lake_source.scan_lake_days(s, runs.lake_store(s, d).lake_path),
    "SELECT DISTINCT sim_day FROM lake",
)
register(
    "upsert_zone_windows",
    lambda s, d: runs.updated_window_store(s, d).zone_windows(s).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM zone_window",
)
register(
    "upsert_running_totals",
    lambda s, d: runs.lake_store(s, d).running_totals(s, SETTINGS).select(*cols(RUNNING)),
    f"SELECT {RUNNING} FROM running",
)
register(
    "append_stream_quality",
    lambda s, d: runs.lake_store(s, d)
    .quality(s)
    .select(
        F.col("batch_id").cast("int").alias("batch_id"),
        "total_events",
        "clean_events",
        "invalid_events",
        "duplicate_events",
        "avg_lag_seconds",
        "max_lag_seconds",
        "recorded_at",
    ),
    """
    SELECT CAST(b AS INTEGER) AS batch_id, total_events, clean_events, invalid_events,
           total_events - invalid_events - clean_events AS duplicate_events,
           lag_sum / clean_events / 1e6 AS avg_lag_seconds, lag_max / 1e6 AS max_lag_seconds,
           TIMESTAMP '2024-01-31 01:00:00' AS recorded_at
    FROM (SELECT CASE WHEN redelivery = 1 AND n % 100 = 53 THEN 1 ELSE 0 END AS b,
                 count(*) AS total_events, count(invalid_reason) AS invalid_events
          FROM graded GROUP BY 1)
    JOIN (SELECT b, count(*) AS clean_events, CAST(sum(lag) AS DOUBLE) AS lag_sum,
                 CAST(max(lag) AS DOUBLE) AS lag_max
          FROM (SELECT CASE WHEN redelivery = 1 AND n % 100 = 53 THEN 1 ELSE 0 END AS b,
                       epoch_us(TIMESTAMP '2024-01-31 01:00:00') - epoch_us(event_time) AS lag
                FROM lake) GROUP BY 1) USING (b)""",
)
register(
    "replace_day",
    lambda s, d: runs.billed_store(s, d)
    .bills(s)
    .where(F.col("sim_day") == CURRENT_DAY)
    .select(*bills.BILL_COLUMNS, "run_id"),
    f"SELECT {BILL_SQL}, 'run-b' AS run_id FROM bill WHERE sim_day = {CURRENT_DAY}",
)
register(
    "upsert_reconciliation",
    lambda s, d: runs.billed_store(s, d).reconciliation(s).select(*cols(RECON), "run_id"),
    f"SELECT {RECON}, CASE WHEN sim_day = {CURRENT_DAY} THEN 'run-b' ELSE 'backfill' END AS run_id "
    "FROM recon",
)
register(
    "retain_recent",
    lambda s, d: grid.retain_recent(
        given.stored_windows(s, d, AS_OF), "window_start", AS_OF, SETTINGS
    ).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM window_now WHERE window_start >= {moment(AS_OF)} - INTERVAL 6 HOUR",
)


def report_csv(s, d):
    path = work_folder(s, "report")
    sinks.write_report_csv(runs.billed_store(s, d).bills(s), path)
    schema = ", ".join(
        f"{name} {kind}"
        for name, kind in stored_bills(s, d).select(*sinks.REPORT_COLUMNS).dtypes
    )
    return s.read.option("header", True).schema(f"{schema}, sim_day int").csv(path)


register(
    "write_report_csv",
    report_csv,
    f"SELECT {', '.join(sinks.REPORT_COLUMNS)}, sim_day FROM bill",
)
register(
    "scan_table",
    lambda s, d: scan_table(
        s,
        runs.billed_store(s, d).tariffs_path,
        where=(F.col("run_id") == "backfill") & (F.col("tariff_rate") > 30),
    ).drop("run_id"),
    "SELECT household_id, sim_day, tariff_rate, billing_tier, subsidy_flag FROM tariff_ref "
    f"WHERE sim_day < {CURRENT_DAY} AND tariff_rate > 30",
)
register(
    "upsert_heartbeat",
    lambda s, d: runs.heartbeat_store(s, d).heartbeats(s),
    """
    SELECT component, last_heartbeat, status, detail FROM heartbeat
    QUALIFY row_number() OVER (PARTITION BY component
        ORDER BY last_heartbeat DESC, status DESC, detail DESC) = 1""",
)

# --- projections, filters, predicates -----------------------------------------------------------

register(
    "grade_readings",
    lambda s, d: given.graded(s, d).select(*READING, "invalid_reason"),
    f"SELECT {READING_SQL}, invalid_reason FROM graded",
)
register(
    "split_clean",
    lambda s, d: readings.split_clean(given.graded(s, d)).select(*READING),
    f"SELECT {READING_SQL} FROM graded WHERE invalid_reason IS NULL",
)
register(
    "split_invalid",
    lambda s, d: readings.split_invalid(given.graded(s, d)).select(*READING, "invalid_reason"),
    f"SELECT {READING_SQL}, invalid_reason FROM graded WHERE invalid_reason IS NOT NULL",
)
register(
    "with_sim_day",
    lambda s, d: given.clean(s, d).select("event_id", "offset", "event_time", "sim_day"),
    'SELECT event_id, "offset", event_time, sim_day FROM clean',
)
register(
    "with_day_fraction",
    lambda s, d: readings.with_day_fraction(given.clean(s, d), SETTINGS).select(
        "event_id", "offset", "day_fraction"
    ),
    f'SELECT event_id, "offset", {oracle.fraction("event_time")} AS day_fraction FROM clean',
)
register(
    "day_bounds",
    lambda s, d: readings.day_bounds(given.clean(s, d).select("sim_day").distinct(), SETTINGS),
    """
    SELECT DISTINCT sim_day, TIMESTAMP '2024-01-01' + sim_day * INTERVAL 1 DAY AS day_start,
           TIMESTAMP '2024-01-01' + (sim_day + 1) * INTERVAL 1 DAY AS day_end FROM clean""",
)
register(
    "with_daylight",
    lambda s, d: readings.with_daylight(given.clean(s, d), SETTINGS).select(
        "event_id", "offset", "daylight"
    ),
    f'SELECT event_id, "offset", {oracle.daylight(oracle.fraction("event_time"))} AS daylight '
    "FROM clean",
)
register(
    "with_time_of_day",
    lambda s, d: readings.with_time_of_day(given.clean(s, d), SETTINGS).select(
        "event_id", "offset", "day_fraction", "sim_time_of_day"
    ),
    f"""
    SELECT event_id, "offset", {oracle.half_up('f', 3)} AS day_fraction,
           lpad(CAST(CAST(floor(f * 24) AS INTEGER) AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST(CAST(floor((f * 24) % 1 * 60) AS INTEGER) AS VARCHAR), 2, '0')
             AS sim_time_of_day
    FROM (SELECT event_id, "offset", {oracle.fraction('event_time')} AS f FROM clean)""",
)


def reading_rule(name: str, column, sql: str) -> None:
    """A rule of two measurements, applied to every clean reading."""
    register(
        name,
        lambda s, d: given.clean(s, d).select("event_id", "offset", column().alias(name)),
        f'SELECT event_id, "offset", {sql} AS {name} FROM clean',
    )


def used():
    return F.col("power_consumption_kwh")


def made():
    return F.col("solar_generation_kwh")


U, M = "power_consumption_kwh", "solar_generation_kwh"
reading_rule(
    "renewable_pct",
    lambda: billing.renewable_pct(used(), made()),
    oracle.RENEWABLE.format(c=U, s=M),
)
reading_rule(
    "net_consumption",
    lambda: billing.net_consumption(used(), made(), SETTINGS),
    f"CAST(greatest(CAST({U} AS DECIMAL(18,6)) - CAST({M} AS DECIMAL(18,6)), 0) AS DOUBLE)",
)
reading_rule(
    "solar_export",
    lambda: billing.solar_export(used(), made(), SETTINGS),
    f"CAST(greatest(CAST({M} AS DECIMAL(18,6)) - CAST({U} AS DECIMAL(18,6)), 0) AS DOUBLE)",
)
reading_rule(
    "solar_contribution_pct",
    lambda: billing.solar_contribution_pct(used(), made()),
    oracle.pct(U, M),
)
register(
    "subsidy_discount_pct",
    lambda s, d: given.stored_tariffs(s, d).select(
        "household_id",
        "sim_day",
        billing.subsidy_discount_pct(F.col("subsidy_flag"), SETTINGS).alias(
            "subsidy_discount_pct"
        ),
    ),
    "SELECT household_id, sim_day, CASE WHEN subsidy_flag THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END "
    "AS subsidy_discount_pct FROM tariff_ref",
)
register("bill_amount", flagship, f"SELECT {BILL_SQL} FROM bill")
register(
    "validate_tariff",
    lambda s, d: given.tariff_rows(s, d).select(
        "household_id", "sim_day", "tariff_rate", "billing_tier", "published_at", "is_valid"
    ),
    "SELECT household_id, sim_day, tariff_rate, billing_tier, published_at, is_valid FROM tariff_row",
)
register(
    "parse_subsidy_flag",
    lambda s, d: given.tariff_extract(s, d).select(
        "household_id",
        F.col("sim_day").cast("int").alias("sim_day"),
        billing.subsidy_flag(F.col("subsidy_flag")).alias("subsidy_flag"),
    ),
    "SELECT household_id, sim_day, subsidy_flag FROM tariff_raw",
)
register(
    "rejected_tariff_rows",
    lambda s, d: tariffs.rejected_tariff_rows(given.stored_tariff_rows(s, d)),
    "SELECT household_id, sim_day, raw_rate FROM tariff_row WHERE NOT is_valid",
)
register(
    "tariff_source",
    lambda s, d: enriched(s, d).groupBy("sim_day", "tariff_source").agg(
        F.count(F.lit(1)).alias("households")
    ),
    "SELECT sim_day, tariff_source, count(*) AS households FROM enriched GROUP BY 1, 2",
)


def day_joined(s, d):
    """The single-day form: today's tariff, then the newest of any earlier day."""
    reference = given.stored_tariffs(s, d)
    today = stored_daily(s, d).where(F.col("sim_day") == CURRENT_DAY)
    joined = tariffs.join_tariff_today(today, reference)
    previous = tariffs.previous_tariffs(reference, CURRENT_DAY)
    return tariffs.join_tariff_previous(joined, previous)


register(
    "coalesce_tariff",
    lambda s, d: tariffs.with_effective_tariff(day_joined(s, d)),
    f"SELECT {DAILY_SQL}, tariff_rate, billing_tier, subsidy_flag, tariff_source FROM enriched "
    f"WHERE sim_day = {CURRENT_DAY}",
)
register(
    "renewable_flags",
    lambda s, d: grid.renewable_flags(given.stored_windows(s, d), AS_OF, SETTINGS).select(
        "grid_zone", "window_start", "below_threshold", "low_renewable"
    ),
    f"""
    SELECT grid_zone, window_start, renewable_pct < {SETTINGS.low_renewable_pct} AS below_threshold,
           renewable_pct < {SETTINGS.low_renewable_pct}
             AND {oracle.daylight(oracle.fraction(moment(AS_OF)))} AS low_renewable
    FROM zone_window""",
)
STATE = "component, status, age_seconds, stale_after_seconds, detail, last_heartbeat"
register(
    "component_state",
    lambda s, d: health.component_state(given.heartbeats(s, d), AS_OF, SETTINGS),
    f"SELECT {STATE} FROM state",
)
register(
    "point_filters",
    lambda s, d: bills.point_filters(stored_bills(s, d), sim_day=12),
    f"SELECT {BILL_SQL} FROM bill WHERE sim_day = 12",
)


def household_bills(s, d):
    """All bills of one household, the first by name."""
    stored = stored_bills(s, d)
    household = stored.agg(F.min("household_id")).first()[0]
    return bills.point_filters(stored, household_id=household)


register(
    "household_bills",
    household_bills,
    f"SELECT {BILL_SQL} FROM bill WHERE household_id = (SELECT min(household_id) FROM bill)",
)
register(
    "event_lag",
    lambda s, d: readings.event_lag(
        given.lake(s, d).withColumn("processed_at", given.processed_at())
    ).select("event_id", "batch_id", "lag_seconds"),
    f"""
    SELECT event_id, batch_id,
           CAST({oracle.EPOCH_US} + 30000000 + (batch_id + 1) * 3600000000 - epoch_us(event_time)
                AS DOUBLE) / 1e6 AS lag_seconds
    FROM lake""",
)

# --- joins ---------------------------------------------------------------------------------------

register(
    "join_tariff_today",
    lambda s, d: tariffs.join_tariff_today(stored_daily(s, d), given.stored_tariffs(s, d)),
    f"SELECT {DAILY_SQL}, tariff_rate, billing_tier, subsidy_flag "
    "FROM daily LEFT JOIN tariff_ref USING (household_id, sim_day)",
)
register(
    "join_tariff_previous",
    lambda s, d: tariffs.join_tariff_previous(
        stored_daily(s, d).where(F.col("sim_day") == CURRENT_DAY),
        snapshots.previous_tariffs(
            snapshots.household_state(s, runs.billed_store(s, d), CURRENT_DAY - 1)
        ),
    ),
    f"""
    SELECT d.*, p.sim_day AS prev_sim_day, p.tariff_rate AS prev_tariff_rate,
           p.billing_tier AS prev_billing_tier, p.subsidy_flag AS prev_subsidy_flag
    FROM daily d LEFT JOIN (
        SELECT * FROM tariff_ref WHERE sim_day < {CURRENT_DAY}
        QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY sim_day DESC) = 1) p
      ON d.household_id = p.household_id
    WHERE d.sim_day = {CURRENT_DAY}""",
)
register(
    "asof_tariff",
    enriched,
    f"SELECT {DAILY_SQL}, tariff_rate, billing_tier, subsidy_flag, tariff_sim_day, tariff_source "
    "FROM enriched",
)
LATEST_TARIFF = """
    SELECT household_id, arg_max(tariff_rate, sim_day) AS tariff_rate,
           arg_max(billing_tier, sim_day) AS billing_tier,
           arg_max(subsidy_flag, sim_day) AS subsidy_flag, max(sim_day) AS tariff_sim_day
    FROM tariff_ref GROUP BY 1"""
register(
    "latest_tariff_per_household",
    lambda s, d: snapshots.latest_tariffs(snapshots.household_state(s, runs.billed_store(s, d))),
    LATEST_TARIFF,
)
LATEST_BILL = """
    SELECT household_id, arg_max(bill_amount, sim_day) AS last_final_bill,
           max(sim_day) AS last_final_sim_day FROM bill GROUP BY 1"""
register(
    "latest_bill_per_household",
    lambda s, d: snapshots.latest_bills(snapshots.household_state(s, runs.billed_store(s, d))),
    LATEST_BILL,
)
register(
    "household_state",
    lambda s, d: snapshots.household_state(s, runs.rebilled_store(s, d)),
    f"""
    SELECT coalesce(t.household_id, b.household_id) AS household_id, tariff_rate, billing_tier, subsidy_flag,
           tariff_sim_day, last_final_bill, last_final_sim_day
    FROM ({LATEST_TARIFF}) t FULL JOIN ({LATEST_BILL}) b ON t.household_id = b.household_id""",
)


def pending(s, d):
    """Recent lake days when the bills of day 27 and of all days from 28 on are still missing."""
    lake_days = given.stored_lake(s, d).select("sim_day").distinct()
    done = (F.col("sim_day") != 27) & (F.col("sim_day") < 28)
    billed = stored_bills(s, d).where(done).select("sim_day").distinct()
    return reconciliation.pending_days(s, lake_days, billed, CURRENT_DAY, SETTINGS)


register(
    "pending_days",
    pending,
    """
    SELECT DISTINCT sim_day FROM lake WHERE sim_day BETWEEN 26 AND 28
      AND sim_day NOT IN (SELECT sim_day FROM bill WHERE sim_day <> 27 AND sim_day < 28)""",
)
register(
    "reconcile_days",
    lambda s, d: reconciliation.reconcile_days(given.stored_running(s, d), stored_daily(s, d), SETTINGS),
    "SELECT sim_day, speed_consumption_kwh, batch_consumption_kwh, drift_pct, speed_readings, "
    "batch_readings FROM recon_days",
)
register(
    "unbilled_households",
    lambda s, d: bills.unbilled_households(enriched(s, d)),
    "SELECT household_id, sim_day FROM enriched WHERE tariff_source = 'missing'",
)
register(
    "missing_components",
    lambda s, d: health.missing_components(
        s, health.latest_heartbeat(given.heartbeats(s, d)), SETTINGS
    ),
    "SELECT component FROM (VALUES ('meter_producer'), ('speed_layer'), ('alerts_engine')) e(component) "
    "WHERE component NOT IN (SELECT component FROM heartbeat)",
)


def merged_alerts(s, d):
    opened = alerts.current_alerts(alert_changes(s, d).where("pass_id = 1"))
    return alerts.alert_merge(opened, candidates(s, d, AS_OF, 28)).select(
        "alert_type", "scope", "action"
    )


register(
    "alert_merge",
    merged_alerts,
    """
    SELECT alert_type, scope,
           CASE transition WHEN 'triggered' THEN 'insert' WHEN 'refreshed' THEN 'refresh'
                ELSE 'resolve' END AS action
    FROM changes
    UNION ALL
    SELECT alert_type, scope, 'keep' FROM open_early o
    WHERE NOT EXISTS (SELECT 1 FROM changes c
                      WHERE c.alert_type = o.alert_type AND c.scope = o.scope)""",
)


def enriched_live(s, d):
    path = work_folder(s, "latest-tariffs")
    tariffs.latest_tariff_per_household(given.stored_tariffs(s, d)).write.parquet(path)
    return runs.enriched_stream(s, d, path).select(
        "event_id",
        "offset",
        "household_id",
        "sim_day",
        "power_consumption_kwh",
        "tariff_rate",
        "billing_tier",
        "subsidy_flag",
        "tariff_sim_day",
    )


register(
    "enrich_live_with_tariff",
    enriched_live,
    f"""
    SELECT event_id, "offset", household_id, sim_day, power_consumption_kwh, tariff_rate,
           billing_tier, subsidy_flag, tariff_sim_day
    FROM clean LEFT JOIN ({LATEST_TARIFF}) USING (household_id)""",
)

register(
    "stream_priced_live",
    lambda s, d: runs.priced_live(s, d).select(
        "event_id", "offset", "household_id", "sim_day", "power_consumption_kwh", "tariff_rate",
        "billing_tier", "subsidy_flag", "tariff_sim_day",
    ),
    f"""
    SELECT event_id, "offset", household_id, sim_day, power_consumption_kwh, tariff_rate,
           billing_tier, subsidy_flag, tariff_sim_day
    FROM clean LEFT JOIN ({LATEST_TARIFF}) USING (household_id)""",
)

# --- aggregations --------------------------------------------------------------------------------

register(
    "zone_window_metrics",
    lambda s, d: given.windows(s, d).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM zone_window",
)


def household_counts(s, d):
    """The approximate household counts of a zone add up to within a twentieth of the exact ones."""
    clean = given.clean(s, d)
    by_window = [F.window("event_time", SETTINGS.window, SETTINGS.slide), F.col("grid_zone")]
    exact_count = clean.groupBy(*by_window).agg(F.count_distinct("household_id").alias("exact"))
    exact_count = exact_count.groupBy("grid_zone").agg(F.sum("exact").alias("exact_households"))
    counted = given.windows(s, d).groupBy("grid_zone").agg(F.sum("household_count").alias("n"))
    error = F.abs(F.col("n") - F.col("exact_households")) / F.col("exact_households")
    return counted.join(exact_count, "grid_zone").select(
        "grid_zone", "exact_households", (error <= 0.05).alias("within_tolerance")
    )


register(
    "zone_window_household_count",
    household_counts,
    "SELECT grid_zone, CAST(sum(exact_households) AS BIGINT) AS exact_households, "
    "TRUE AS within_tolerance FROM zone_window GROUP BY 1",
)


def window_household_counts(s, d):
    """Every window's approximate count of households beside its exact one.

    The sketch has a relative standard deviation of a fortieth; six of them are allowed. Even of
    two households both may fall into one of its registers, which makes a small count one less.
    """
    by_window = [F.window("event_time", SETTINGS.window, SETTINGS.slide).alias("w"), F.col("grid_zone")]
    exact_count = (
        given.clean(s, d)
        .groupBy(*by_window)
        .agg(F.count_distinct("household_id").alias("exact_households"))
        .select("grid_zone", F.col("w.start").alias("window_start"), "exact_households")
    )
    counted = given.windows(s, d).select("grid_zone", "window_start", F.col("household_count").alias("n"))
    error = F.abs(F.col("n") - F.col("exact_households"))
    return counted.join(exact_count, ["grid_zone", "window_start"]).select(
        "grid_zone",
        "window_start",
        "exact_households",
        (error <= 1 + 0.15 * F.col("exact_households")).alias("within_tolerance"),
    )


register(
    "window_household_count",
    window_household_counts,
    "SELECT grid_zone, window_start, CAST(exact_households AS BIGINT) AS exact_households, "
    "TRUE AS within_tolerance FROM zone_window",
)
register("household_daily", daily, f"SELECT {DAILY_SQL} FROM daily")
register(
    "household_microbatch_totals",
    given.partials,
    "SELECT batch_id, household_id, sim_day, grid_zone, consumption_kwh, solar_kwh, reading_count, "
    "last_event_time FROM partial",
)
register(
    "dedup_global",
    lambda s, d: exact(s, d).select(*READING, "sim_day"),
    f"SELECT {READING_SQL}, sim_day FROM exact",
)
register(
    "dedup_microbatch",
    lambda s, d: given.lake(s, d).select(*READING, "batch_id"),
    f"SELECT {READING_SQL}, batch_id FROM lake",
)


def quality_with_reasons(s, d):
    rows = given.quality_rows(s, d)
    entries = F.transform(
        F.map_entries("invalid_by_reason"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return rows.select(
        "batch_id",
        "total_events",
        "clean_events",
        "invalid_events",
        "duplicate_events",
        "avg_lag_seconds",
        "max_lag_seconds",
        F.array_join(F.sort_array(entries), ",").alias("invalid_by_reason"),
    )


register(
    "microbatch_quality",
    quality_with_reasons,
    """
    SELECT q.batch_id, total_events, clean_events, invalid_events, duplicate_events,
           avg_lag_seconds, max_lag_seconds, coalesce(r.reasons, '') AS invalid_by_reason
    FROM quality q LEFT JOIN (
        SELECT batch_id, string_agg(invalid_reason || '=' || events, ',' ORDER BY invalid_reason)
                 AS reasons FROM reason GROUP BY 1) r ON q.batch_id = r.batch_id""",
)
register(
    "invalid_by_reason",
    lambda s, d: consumption.invalid_by_reason(given.graded(s, d), "batch_id"),
    "SELECT batch_id, invalid_reason, events FROM reason",
)
KWH_SUM = "CAST(sum(CAST({} AS DECIMAL(18,6))) AS DOUBLE)"
SUMMARY = f"""
    SELECT sim_day, grid_zone, count(*) AS households,
           {oracle.half_up(KWH_SUM.format('total_consumption_kwh'), 2)} AS total_consumption_kwh,
           {oracle.half_up(KWH_SUM.format('total_solar_kwh'), 2)} AS total_solar_kwh,
           {oracle.half_up(KWH_SUM.format('net_consumption_kwh'), 2)} AS net_consumption_kwh,
           {oracle.half_up(KWH_SUM.format('solar_contribution_pct') + ' / count(*)', 1)}
             AS avg_solar_contribution_pct,
           {oracle.half_up(KWH_SUM.format('bill_amount'), 2)} AS total_billed,
           {oracle.half_up(KWH_SUM.format('bill_amount') + ' / count(*)', 2)} AS avg_bill
    FROM bill"""
register(
    "billing_zone_summary",
    lambda s, d: bills.billing_zone_summary(stored_bills(s, d), SETTINGS),
    f"{SUMMARY} GROUP BY 1, 2",
)
GRID_TOTALS = f"""
    SELECT {oracle.half_up('c', 3)} AS grid_total_consumption_kwh,
           {oracle.half_up('s', 3)} AS grid_total_solar_kwh,
           {oracle.half_up(oracle.RENEWABLE.format(c='c', s='s'), 2)} AS grid_renewable_pct
    FROM (SELECT coalesce({KWH_SUM.format('total_consumption_kwh')}, 0) AS c,
                 coalesce({KWH_SUM.format('total_solar_kwh')}, 0) AS s FROM live_window)"""
register(
    "grid_totals",
    lambda s, d: grid.grid_totals(
        grid.latest_complete_window(given.stored_windows(s, d, AS_OF), AS_OF), SETTINGS
    ),
    GRID_TOTALS,
)
register("reconciliation_metrics", reconciled, f"SELECT {RECON} FROM recon")
register(
    "tariff_stats",
    lambda s, d: tariffs.tariff_stats(given.stored_tariff_rows(s, d)),
    "SELECT sim_day, tariff_rows, invalid_tariff_rows, duplicate_tariff_rows FROM tariff_stat",
)
ROLLUP = (
    "total_events, clean_events, invalid_events, duplicate_events, avg_lag_seconds, "
    "max_lag_seconds, micro_batches"
)
RATE = oracle.half_up("rate", 2)
register(
    "stream_quality_rollup",
    lambda s, d: grid.stream_quality_rollup(given.stored_quality(s, d), AS_OF, SETTINGS),
    f"SELECT {ROLLUP}, {RATE} AS invalid_rate_pct FROM rollup_now",
)
REASONS = f"""
    SELECT invalid_reason AS reason, CAST(sum(events) AS BIGINT) AS n
    FROM reason JOIN quality USING (batch_id)
    WHERE recorded_at > {moment(AS_OF)} - INTERVAL 6 HOUR AND recorded_at <= {moment(AS_OF)}
    GROUP BY 1"""
register(
    "invalid_reason_rollup",
    lambda s, d: grid.invalid_reason_rollup(given.stored_quality(s, d), AS_OF, SETTINGS),
    REASONS,
)
register(
    "recent_lag",
    lambda s, d: grid.recent_lag(seen_quality(s, d), SETTINGS).select(
        half_up(F.col("avg_lag_seconds"), 6).alias("avg_lag_seconds")
    ),
    f"SELECT {oracle.half_up('lag', 6)} AS avg_lag_seconds FROM lag_now",
)
register(
    "open_alerts_by_type",
    lambda s, d: health.open_alerts_by_type(current(s, d)),
    "SELECT alert_type, count(*) AS n FROM alert WHERE NOT resolved GROUP BY 1",
)
register(
    "latest_billed_day",
    lambda s, d: reconciliation.newest_billed_day(runs.billed_store(s, d).reconciliation(s)),
    "SELECT max(sim_day) AS sim_day FROM bill",
)
register(
    "billed_totals",
    lambda s, d: bills.billed_total(stored_bills(s, d), "bill_amount", "total_billed"),
    "SELECT count(*) AS rows, CAST(sum(CAST(bill_amount AS DECIMAL(18,2))) AS DOUBLE) "
    "AS total_billed FROM bill",
)
KPIS = f"""
    SELECT sim_day, count(*) AS households_billed, {KWH_SUM.format('bill_amount')} AS total_billed,
           {KWH_SUM.format('total_consumption_kwh')} AS consumption_kwh,
           {KWH_SUM.format('total_solar_kwh')} AS solar_kwh FROM bill"""
register(
    "report_kpis",
    lambda s, d: bills.report_kpis(stored_bills(s, d), SETTINGS),
    f"{KPIS} GROUP BY 1",
)

# --- window functions ----------------------------------------------------------------------------

register(
    "dedup_tariff",
    given.tariff_reference,
    "SELECT household_id, sim_day, tariff_rate, billing_tier, subsidy_flag FROM tariff_ref",
)
register(
    "latest_complete_window",
    lambda s, d: grid.latest_complete_window(given.stored_windows(s, d, AS_OF), AS_OF).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM live_window",
)
register(
    "latest_closed_window",
    lambda s, d: grid.latest_closed_window(given.stored_windows(s, d, AS_OF), AS_OF).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM closed_now",
)
register(
    "previous_tariffs",
    lambda s, d: snapshots.previous_tariffs(
        snapshots.household_state(s, runs.billed_store(s, d), CURRENT_DAY - 1)
    ),
    f"""
    SELECT household_id, sim_day AS prev_sim_day, tariff_rate AS prev_tariff_rate,
           billing_tier AS prev_billing_tier, subsidy_flag AS prev_subsidy_flag
    FROM tariff_ref WHERE sim_day < {CURRENT_DAY}
    QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY sim_day DESC) = 1""",
)

# --- sorts, limits -------------------------------------------------------------------------------

register(
    "top_bills",
    lambda s, d: bills.top_bills(runs.billed_store(s, d).newest_bills(s).select(*bills.BILL_COLUMNS)),
    f"SELECT {BILL_SQL} FROM bill WHERE sim_day = (SELECT max(sim_day) FROM bill) "
    "ORDER BY bill_amount DESC, household_id LIMIT 5",
)
DAYS = "sim_day, households_billed, total_billed, batch_consumption_kwh, drift_pct"
register(
    "billing_days",
    lambda s, d: reconciliation.billing_days(stored_recon(s, d)),
    f"SELECT {DAYS} FROM recon ORDER BY sim_day DESC LIMIT 60",
)
register(
    "reconciliation_recent",
    lambda s, d: reconciliation.reconciliation_recent(stored_recon(s, d), 10),
    f"SELECT {RECON} FROM recon ORDER BY sim_day DESC LIMIT 10",
)
register(
    "alerts_list",
    lambda s, d: alerts.alerts_list(current(s, d), resolved=True).drop("id"),
    f"SELECT {ALERT} FROM alert WHERE resolved ORDER BY triggered_at DESC, alert_type, scope LIMIT 50",
)

# --- streaming -----------------------------------------------------------------------------------

register(
    "stream_zone_windows",
    lambda s, d: runs.window_store(s, d).zone_windows(s).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM zone_window",
)


def stream_outputs(s, d):
    """Rows of every table the lake query writes, per table and micro-batch."""
    store = runs.lake_store(s, d)

    def counted(name, rows):
        return rows.groupBy(F.col("batch_id").cast("int").alias("batch_id")).agg(
            F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows")
        )

    parts = scan_table(s, store.partial_totals_path)
    return (
        counted("lake", store.lake(s))
        .unionByName(counted("quarantine", store.quarantine(s)))
        .unionByName(counted("totals", parts))
        .unionByName(counted("quality", store.quality(s)))
    )


BATCH = "CASE WHEN redelivery = 1 AND n % 100 = 53 THEN 1 ELSE 0 END AS batch_id"
register(
    "stream_lake",
    stream_outputs,
    f"""
    SELECT batch_id, 'lake' AS output, count(*) AS rows FROM (SELECT {BATCH} FROM lake) GROUP BY 1
    UNION ALL
    SELECT batch_id, 'quarantine', count(*)
    FROM (SELECT {BATCH} FROM graded WHERE invalid_reason IS NOT NULL) GROUP BY 1
    UNION ALL
    SELECT batch_id, 'totals', count(*)
    FROM (SELECT DISTINCT household_id, sim_day, grid_zone, {BATCH} FROM lake) GROUP BY 1
    UNION ALL
    SELECT batch_id, 'quality', 1 FROM (SELECT DISTINCT {BATCH} FROM graded)""",
)
register(
    "stream_running_totals",
    lambda s, d: runs.lake_store(s, d)
    .running_totals(s, SETTINGS)
    .where(F.col("sim_day") == CURRENT_DAY)
    .select(*cols(RUNNING)),
    f"SELECT {RUNNING} FROM running WHERE sim_day = {CURRENT_DAY}",
)
register(
    "stream_late_windows",
    lambda s, d: runs.late_store(s, d).zone_windows(s).select(*WINDOW),
    f"""
    SELECT {WINDOW_SQL} FROM ({oracle.window_sql(
        "clean",
        "WHERE n % 97 <> 11 OR make_timestamp((epoch_us(event_time) // 900000000 - k + 2) * 900000000)"
        " > (SELECT max(event_time) - INTERVAL 1 MINUTE FROM clean WHERE n % 97 <> 11)",
    )})""",
)
register(
    "stream_late_lake",
    lambda s, d: runs.late_store(s, d).lake(s).select("event_id", "sim_day"),
    "SELECT event_id, sim_day FROM exact",
)
register(
    "stream_microbatch_dedup",
    lambda s, d: runs.lake_store(s, d).lake(s).groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("readings")
    ),
    "SELECT sim_day, count(*) AS rows, count(DISTINCT event_id) AS readings FROM lake GROUP BY 1",
)
register(
    "stream_dedup_watermark",
    lambda s, d: runs.deduplicated_window_store(s, d).zone_windows(s).select(*WINDOW),
    f"SELECT {WINDOW_SQL} FROM ({oracle.window_sql('exact')})",
)
register(
    "stream_resume",
    lambda s, d: runs.lake_store(s, d)
    .quality(s)
    .agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("total_events").alias("total_events"),
        F.sum("clean_events").alias("clean_events"),
    ),
    """
    SELECT 2 AS batches, (SELECT count(*) FROM graded) AS total_events,
           (SELECT count(*) FROM lake) AS clean_events""",
)
register(
    "stream_rate_limit",
    runs.limited_batches,
    "SELECT count(*) AS rows, TRUE AS limit_kept FROM reading",
)

# --- alerting and health -------------------------------------------------------------------------


def rule(key: str, alert_type: str, query: Query) -> None:
    register(key, query, f"SELECT {CANDIDATE} FROM rules_now WHERE alert_type = '{alert_type}'")


rule(
    "rule_low_renewable",
    "LOW_RENEWABLE",
    lambda s, d: alerts.rule_low_renewable(given.stored_windows(s, d, AS_OF), AS_OF, SETTINGS),
)
rule(
    "rule_no_data",
    "NO_DATA",
    lambda s, d: alerts.rule_no_data(given.heartbeats(s, d), AS_OF, SETTINGS),
)
rule(
    "rule_component_failed",
    "COMPONENT_FAILED",
    lambda s, d: alerts.rule_component_failed(given.heartbeats(s, d), AS_OF),
)
rule(
    "rule_invalid_rate",
    "HIGH_INVALID_RATE",
    lambda s, d: alerts.rule_invalid_rate(seen_quality(s, d), AS_OF, SETTINGS),
)


def lag_rule(s, d):
    rows = alerts.rule_stream_lag(seen_quality(s, d), SETTINGS)
    return rows.withColumn("metric_value", half_up(F.col("metric_value"), 6))


register(
    "rule_stream_lag",
    lag_rule,
    f"""
    SELECT alert_type, scope, severity, message, {oracle.half_up('metric_value', 6)} AS metric_value,
           threshold, breached FROM rules_now WHERE alert_type = 'HIGH_STREAM_LAG'""",
)
rule(
    "rule_drift",
    "RECONCILIATION_DRIFT",
    lambda s, d: alerts.rule_drift(stored_recon(s, d).where(F.col("sim_day") <= 28), SETTINGS),
)
rule(
    "rule_task_failed",
    "PIPELINE_TASK_FAILED",
    lambda s, d: alerts.rule_task_failed(given.run_log(s, d), AS_OF),
)


def gauge_samples(s, d):
    """The load of a zone, sampled at the end of every window; breached above 25 kWh."""
    return given.stored_windows(s, d).select(
        F.col("grid_zone").alias("series"),
        F.col("window_end").alias("sampled_at"),
        (F.col("total_consumption_kwh") > 25).alias("breached"),
    )


register(
    "sustained_breach",
    lambda s, d: alerts.sustained_breach(gauge_samples(s, d), 1800, bucket_seconds=7200),
    """
    SELECT grid_zone AS series, min(window_end) AS started_at, max(window_end) AS ended_at,
           count(*) AS samples,
           CAST(epoch_us(max(window_end)) - epoch_us(min(window_end)) AS DOUBLE) / 1e6 AS held_seconds
    FROM (SELECT grid_zone, window_end, breached,
                 row_number() OVER (PARTITION BY grid_zone ORDER BY window_end)
                   - row_number() OVER (PARTITION BY grid_zone, breached ORDER BY window_end) AS spell
          FROM (SELECT *, total_consumption_kwh > 25 AS breached FROM zone_window))
    WHERE breached GROUP BY grid_zone, spell
    HAVING epoch_us(max(window_end)) - epoch_us(min(window_end)) >= 1800000000""",
)


#: The given events arrive minutes to hours apart, so gaps and intervals are long here.
MONITORED = replace(SETTINGS, sample_gap_seconds=5400.0)
ARRIVAL_SECONDS, STALE_SECONDS = 1800, 3600


def component_arrivals(s, d):
    """Heartbeats as arrivals of their component, looked for at the end of every micro-batch."""
    beats = given.heartbeats(s, d).select(
        F.col("component").alias("series"),
        F.col("last_heartbeat").alias("at"),
        F.lit(1).alias("events"),
    )
    names = F.array(*map(F.lit, ("alerts_engine", "batch_layer", "meter_producer", "speed_layer")))
    looked = given.stored_quality(s, d).select(
        F.explode(names).alias("series"), F.col("recorded_at").alias("sampled_at")
    )
    return alerts.arrival_rate(beats, looked, ARRIVAL_SECONDS)


register(
    "arrival_rate",
    component_arrivals,
    f"""
    SELECT series, recorded_at AS sampled_at, count(component) AS events,
           count(component)::DOUBLE / {ARRIVAL_SECONDS} AS events_per_second
    FROM (SELECT DISTINCT recorded_at, unnest(['alerts_engine', 'batch_layer', 'meter_producer',
                                               'speed_layer']) AS series FROM quality)
    LEFT JOIN heartbeat ON component = series AND last_heartbeat <= recorded_at
                       AND last_heartbeat > recorded_at - INTERVAL {ARRIVAL_SECONDS} SECOND
    GROUP BY ALL""",
)


def monitor_samples(s, d):
    """Gauges of every micro-batch, heartbeat, window and day, as a monitor would have sampled them."""
    quality = given.stored_quality(s, d)

    def gauge(rows, name, label, value, time):
        return rows.select(
            F.lit(name).alias("name"),
            label.alias("label"),
            value.cast("double").alias("value"),
            F.col(time).alias("sampled_at"),
        )

    nothing, speed = F.lit(""), F.lit("speed_layer")
    rate = F.lit(100.0) * F.col("invalid_events") / F.col("total_events")
    low = given.stored_windows(s, d).groupBy("window_end").agg(
        F.count_if(F.col("renewable_pct") < SETTINGS.low_renewable_pct).alias("zones")
    )
    days = stored_recon(s, d).withColumn("day_end", F.timestamp_seconds(
        F.lit(SETTINGS.epoch_seconds) + (F.col("sim_day") + 1) * SETTINGS.day_seconds
    ))
    produced = component_arrivals(s, d).where("series = 'meter_producer'")
    return alerts.union_candidates(
        gauge(quality, "stream_invalid_event_rate_pct", nothing, rate, "recorded_at"),
        gauge(quality, "stream_processing_lag_seconds", nothing, F.col("avg_lag_seconds"), "recorded_at"),
        gauge(quality, "pipeline_component_staleness_seconds", speed, F.col("max_lag_seconds"), "recorded_at"),
        gauge(quality, "pipeline_component_stale_budget_seconds", speed, F.lit(STALE_SECONDS), "recorded_at"),
        gauge(
            given.heartbeats(s, d), "pipeline_component_up", F.col("component"),
            F.when(F.col("status") == "OK", 1).otherwise(0), "last_heartbeat",
        ),
        gauge(produced, alerts.DELIVERY_RATE, nothing, F.col("events_per_second"), "sampled_at"),
        gauge(low, "alerts_active", F.lit("LOW_RENEWABLE"), F.col("zones"), "window_end"),
        gauge(days, "batch_reconciliation_drift_pct", nothing, F.col("drift_pct"), "day_end"),
    )


CRITICAL_RULES = "('PipelineComponentUnhealthy', 'PipelineComponentStale', 'NoMeterEventsProduced')"
register(
    "monitor_alerts",
    lambda s, d: alerts.monitor_alerts(monitor_samples(s, d), MONITORED),
    f"""
    SELECT alert, label, CASE WHEN alert IN {CRITICAL_RULES} THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
           min(taken) AS started_at, max(taken) AS ended_at, count(*) AS samples,
           CAST(epoch_us(max(taken)) - epoch_us(min(taken)) AS DOUBLE) / 1e6 AS held_seconds
    FROM (SELECT *, sum(starts) OVER (PARTITION BY alert, label ORDER BY taken, breached
                                      ROWS UNBOUNDED PRECEDING) AS spell
          FROM (SELECT *, CASE WHEN lag(breached) OVER along = breached
                                AND epoch_us(taken) - epoch_us(lag(taken) OVER along)
                                    <= {MONITORED.sample_gap_seconds * 1e6} THEN 0 ELSE 1 END AS starts
                FROM (SELECT 'HighInvalidEventRate' AS alert, '' AS label, recorded_at AS taken,
                             100.0::DOUBLE * invalid_events / total_events
                               > {SETTINGS.invalid_rate_pct} AS breached FROM quality
                      UNION ALL
                      SELECT 'HighStreamLag', '', recorded_at,
                             coalesce(avg_lag_seconds > {SETTINGS.stream_lag_seconds}, FALSE) FROM quality
                      UNION ALL
                      SELECT 'PipelineComponentStale', 'speed_layer', recorded_at,
                             coalesce(max_lag_seconds > {STALE_SECONDS}, FALSE) FROM quality
                      UNION ALL
                      SELECT 'NoMeterEventsProduced', '', recorded_at, NOT EXISTS (
                               SELECT 1 FROM heartbeat WHERE component = 'meter_producer'
                               AND last_heartbeat <= recorded_at
                               AND last_heartbeat > recorded_at - INTERVAL {ARRIVAL_SECONDS} SECOND)
                      FROM quality
                      UNION ALL
                      SELECT 'LowRenewableContribution', 'LOW_RENEWABLE', window_end,
                             bool_or(coalesce(renewable_pct < {SETTINGS.low_renewable_pct}, FALSE))
                      FROM zone_window GROUP BY window_end
                      UNION ALL
                      SELECT 'ReconciliationDrift', '',
                             make_timestamp({oracle.EPOCH_US} + (sim_day + 1) * {oracle.DAY_US}),
                             coalesce(abs(drift_pct) > {SETTINGS.drift_pct}, FALSE) FROM recon
                      UNION ALL
                      SELECT 'PipelineComponentUnhealthy', component, last_heartbeat, status <> 'OK'
                      FROM heartbeat)
                WINDOW along AS (PARTITION BY alert, label ORDER BY taken, breached)))
    WHERE breached GROUP BY alert, label, spell
    HAVING epoch_us(max(taken)) - epoch_us(min(taken)) >= CASE alert
             WHEN 'HighInvalidEventRate' THEN 120000000 WHEN 'NoMeterEventsProduced' THEN 120000000
             WHEN 'PipelineComponentStale' THEN 30000000
             WHEN 'ReconciliationDrift' THEN 0 WHEN 'LowRenewableContribution' THEN 0
             ELSE 60000000 END""",
)
register(
    "rule_no_events",
    lambda s, d: alerts.rule_no_events(given.stored_quality(s, d), AS_OF, 7200.0),
    f"""
    SELECT 'NO_METER_EVENTS' AS alert_type, 'meter_producer' AS scope, 'CRITICAL' AS severity,
           'Streaming source delivered no events in the last 120 minutes' AS message,
           CAST(coalesce(sum(total_events), 0) AS DOUBLE) AS metric_value, 0.0::DOUBLE AS threshold,
           coalesce(sum(total_events), 0) = 0 AS breached
    FROM quality WHERE recorded_at > {moment(AS_OF)} - INTERVAL 2 HOUR
      AND recorded_at <= {moment(AS_OF)}""",
)


def lifecycle(s, d):
    rows = alert_changes(s, d).where("pass_id = 2")
    is_lag = F.col("alert_type") == "HIGH_STREAM_LAG"
    value = F.when(is_lag, half_up(F.col("metric_value"), 6)).otherwise(F.col("metric_value"))
    return rows.withColumn("metric_value", value).select(*cols(ALERT), "transition")


ROUNDED = ALERT.replace(
    "metric_value",
    "CASE WHEN alert_type = 'HIGH_STREAM_LAG' THEN "
    + oracle.half_up("metric_value", 6)
    + " ELSE metric_value END AS metric_value",
)
register("alert_lifecycle", lifecycle, f"SELECT {ROUNDED}, transition FROM changes")
register(
    "health_overall",
    lambda s, d: views.view_health(s, given.heartbeats(s, d), AS_OF, SETTINGS),
    """
    SELECT 'DEGRADED' AS status, count(*) AS components, 'alerts_engine' AS not_reported_yet
    FROM state""",
)


def gauges(s, d):
    return health.pipeline_gauges(
        s,
        given.heartbeats(s, d),
        given.stored_windows(s, d, AS_OF),
        current(s, d),
        given.stored_quality(s, d),
        stored_recon(s, d),
        AS_OF,
        SETTINGS,
    )


def _gauge(name: str, label: str, value: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS name, {label} AS label, CAST({value} AS DOUBLE) AS value FROM {source}"
    )


NEWEST = "(SELECT * FROM recon ORDER BY sim_day DESC LIMIT 1)"
register(
    "pipeline_gauges",
    gauges,
    "SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _gauge("pipeline_component_staleness_seconds", "component", "age_seconds", "state"),
            _gauge(
                "pipeline_component_stale_budget_seconds",
                "component",
                "stale_after_seconds",
                "state",
            ),
            _gauge(
                "pipeline_component_up",
                "component",
                "CASE WHEN status = 'OK' THEN 1 ELSE 0 END",
                "state",
            ),
            _gauge("zone_renewable_pct_latest", "grid_zone", "renewable_pct", "live_window"),
            _gauge("zone_load_kwh_latest", "grid_zone", "total_consumption_kwh", "live_window"),
            "SELECT 'alerts_active', alert_type, CAST(count(*) AS DOUBLE) FROM alert "
            "WHERE NOT resolved GROUP BY alert_type",
            _gauge("stream_events_last_5m", "'clean'", "clean_events", "rollup_now"),
            _gauge("stream_events_last_5m", "'invalid'", "invalid_events", "rollup_now"),
            _gauge("stream_events_last_5m", "'duplicate'", "duplicate_events", "rollup_now"),
            _gauge("stream_invalid_event_rate_pct", "''", RATE, "rollup_now"),
            _gauge("stream_processing_lag_seconds", "''", "avg_lag_seconds", "rollup_now"),
            _gauge("batch_last_billed_sim_day", "''", "sim_day", NEWEST),
            _gauge("batch_reconciliation_drift_pct", "''", "coalesce(drift_pct, 0)", NEWEST),
            _gauge("batch_total_billed_lkr", "''", "total_billed", NEWEST),
            f"SELECT 'sim_day_current', '', {CURRENT_DAY}::DOUBLE",
        ]
    )
    + ") WHERE value IS NOT NULL",
)

# --- named views ---------------------------------------------------------------------------------

register(
    "view_grid_live",
    lambda s, d: views.view_grid_live(given.stored_windows(s, d, AS_OF), AS_OF, SETTINGS).select(
        *WINDOW, "below_threshold", "low_renewable"
    ),
    f"SELECT {WINDOW_SQL}, renewable_pct < {SETTINGS.low_renewable_pct} AS below_threshold, "
    f"renewable_pct < {SETTINGS.low_renewable_pct} AND "
    f"{oracle.daylight(oracle.fraction(moment(AS_OF)))} AS low_renewable FROM live_window",
)
register(
    "view_grid_history",
    lambda s, d: views.view_grid_history(given.stored_windows(s, d, AS_OF), AS_OF, 360),
    "SELECT grid_zone, window_end, total_consumption_kwh, total_solar_kwh, renewable_pct "
    f"FROM window_now WHERE window_end <= {moment(AS_OF)} "
    f"AND window_end > {moment(AS_OF)} - INTERVAL 360 MINUTE",
)
register(
    "view_households_live",
    lambda s, d: views.view_households_live(given.stored_running(s, d), AS_OF, SETTINGS),
    f"SELECT {RUNNING} FROM running WHERE sim_day = {CURRENT_DAY}",
)
register(
    "view_billing_daily",
    lambda s, d: views.view_billing_daily(
        runs.billed_store(s, d).newest_bills(s).select(*bills.BILL_COLUMNS)
    ),
    f"SELECT {BILL_SQL} FROM bill WHERE sim_day = (SELECT max(sim_day) FROM bill)",
)
register(
    "view_billing_summary",
    lambda s, d: views.view_billing_summary(runs.billed_store(s, d).newest_bills(s), SETTINGS),
    f"{SUMMARY} WHERE sim_day = (SELECT max(sim_day) FROM bill) GROUP BY 1, 2",
)
register(
    "view_billing_days",
    lambda s, d: views.view_billing_days(runs.billed_store(s, d).reconciliation(s)),
    f"SELECT {DAYS}, TIMESTAMP '2024-01-31 01:00:00' AS reconciled_at FROM recon "
    "ORDER BY sim_day DESC LIMIT 60",
)
register(
    "view_reconciliation",
    lambda s, d: views.view_reconciliation(
        runs.billed_store(s, d).reconciliation(s).select(*cols(RECON)), 10
    ),
    f"SELECT {RECON} FROM recon ORDER BY sim_day DESC LIMIT 10",
)
NET = "CAST(CAST(r.consumption_kwh AS DECIMAL(18,6)) - CAST(r.solar_kwh AS DECIMAL(18,6)) AS DECIMAL(18,6))"


def projection(s, d):
    store = runs.billed_store(s, d)
    return views.view_billing_projection_from(
        store.running_totals(s, SETTINGS, [CURRENT_DAY]),
        snapshots.household_state(s, store, CURRENT_DAY - 1),
        AS_OF,
        SETTINGS,
    )


PROJECTION = f"""
    SELECT r.household_id, r.grid_zone, r.consumption_kwh, r.solar_kwh, r.reading_count,
           t.tariff_rate, t.billing_tier, t.subsidy_flag, t.tariff_sim_day, b.last_final_bill,
           b.last_final_sim_day,
           {oracle.half_up(f'greatest({NET}, 0)', 3)} AS net_consumption_kwh,
           {oracle.pct('r.consumption_kwh', 'r.solar_kwh')} AS solar_contribution_pct,
           {oracle.bill(f'greatest({NET}, 0)', 't.tariff_rate', 't.subsidy_flag')}
             AS provisional_bill_so_far,
           CASE WHEN t.tariff_rate IS NULL THEN 'awaiting_first_tariff' ELSE 'provisional' END
             AS status
    FROM running r
    LEFT JOIN ({LATEST_TARIFF.replace('FROM tariff_ref', f'FROM tariff_ref WHERE sim_day < {CURRENT_DAY}')}) t
      ON r.household_id = t.household_id
    LEFT JOIN ({LATEST_BILL.replace('FROM bill', f'FROM bill WHERE sim_day < {CURRENT_DAY}')}) b
      ON r.household_id = b.household_id
    WHERE r.sim_day = {CURRENT_DAY}"""
register("view_billing_projection", projection, PROJECTION)
register(
    "provisional_total",
    lambda s, d: bills.billed_total(projection(s, d), "provisional_bill_so_far", "total_provisional"),
    "SELECT count(*) AS rows, coalesce(CAST(sum(CAST(provisional_bill_so_far AS DECIMAL(18,2))) AS DOUBLE), 0) "
    f"AS total_provisional FROM ({PROJECTION})",
)
register(
    "view_alerts",
    lambda s, d: views.view_alerts(current(s, d))
    .drop("id")
    .withColumn("metric_value", half_up(F.col("metric_value"), 6)),
    "SELECT "
    + ALERT.replace("metric_value", oracle.half_up("metric_value", 6) + " AS metric_value")
    + " FROM alert WHERE NOT resolved ORDER BY triggered_at DESC, alert_type, scope LIMIT 50",
)
register(
    "view_pipeline_status",
    lambda s, d: views.view_pipeline_status(
        given.heartbeats(s, d), given.stored_quality(s, d), AS_OF, SETTINGS
    ),
    "SELECT 'component' AS section, component AS name, status, age_seconds AS value FROM state "
    + " ".join(
        f"UNION ALL SELECT 'stream_quality', '{name}', NULL, CAST({value} AS DOUBLE) FROM rollup_now"
        for name, value in [*((c, c) for c in cols(ROLLUP)), ("invalid_rate_pct", RATE)]
    )
    + f" UNION ALL SELECT 'invalid_by_reason', reason, NULL, CAST(n AS DOUBLE) FROM ({REASONS})",
)


def report_part(name: str) -> Query:
    def query(s, d):
        store = runs.billed_store(s, d)
        return report.report_day(store.bills(s), store.reconciliation(s), CURRENT_DAY, SETTINGS)[
            name
        ]

    return query


register(
    "report_day",
    report_part("bills"),
    f"SELECT {', '.join(sinks.REPORT_COLUMNS)} FROM bill WHERE sim_day = {CURRENT_DAY}",
)
register(
    "report_day_zones",
    report_part("zones"),
    f"""
    SELECT sim_day, grid_zone, count(*) AS households,
           {KWH_SUM.format('total_consumption_kwh')} AS consumption,
           {KWH_SUM.format('total_solar_kwh')} AS solar,
           {KWH_SUM.format('solar_contribution_pct')} / count(*) AS solar_pct,
           {KWH_SUM.format('bill_amount')} AS billed
    FROM bill WHERE sim_day = {CURRENT_DAY} GROUP BY 1, 2""",
)
register(
    "report_day_reconciliation",
    lambda s, d: report_part("reconciliation")(s, d).select(*cols(RECON)),
    f"SELECT {RECON} FROM recon WHERE sim_day = {CURRENT_DAY}",
)

# --- audits --------------------------------------------------------------------------------------

register(
    "audit_bills",
    lambda s, d: audit.audit_bills(
        stored_bills(s, d).withColumn("bill_amount", F.col("bill_amount") + F.col("sim_day") % 2 / 50),
        SETTINGS,
    ).select("household_id", "sim_day", "expected_amount"),
    "SELECT household_id, sim_day, bill_amount AS expected_amount FROM bill WHERE sim_day % 2 = 1",
)


def busiest_windows(s, d):
    """The windows with the most events; most zones have none of them."""
    windows = given.stored_windows(s, d)
    most = windows.agg(F.max("event_count").alias("event_count"))
    return windows.join(most, "event_count", "left_semi")


register(
    "audit_zone_coverage",
    lambda s, d: audit.audit_zone_coverage(s, busiest_windows(s, d), SETTINGS),
    f"SELECT grid_zone FROM (VALUES {oracle.ZONES}) z(grid_zone) WHERE grid_zone NOT IN "
    "(SELECT grid_zone FROM zone_window WHERE event_count = (SELECT max(event_count) FROM zone_window))",
)
register(
    "audit_quarantine",
    lambda s, d: audit.audit_quarantine(runs.lake_store(s, d).quarantine(s)),
    "SELECT invalid_reason, CAST(sum(events) AS BIGINT) AS events FROM reason GROUP BY 1",
)


def quarantine_with_loss(s, d):
    """The audit of a quarantine table that has lost one of its reasons."""
    store = runs.lake_store(s, d)
    left = store.quarantine(s).where("invalid_reason <> 'unknown_zone'")
    return audit.audit_lost_quarantine(left, store.quality(s)).select(
        F.col("batch_id").cast("int").alias("batch_id"), "invalid_events", "quarantined"
    )


register(
    "audit_lost_quarantine",
    quarantine_with_loss,
    f"""
    SELECT batch_id, count(*) AS invalid_events,
           count(*) FILTER (invalid_reason <> 'unknown_zone') AS quarantined
    FROM (SELECT {BATCH}, invalid_reason FROM graded WHERE invalid_reason IS NOT NULL) GROUP BY 1
    HAVING count(*) FILTER (invalid_reason = 'unknown_zone') > 0""",
)
register(
    "backfill_days",
    lambda s, d: runs.billed_store(s, d).bills(s).select(*bills.BILL_COLUMNS),
    f"SELECT {BILL_SQL} FROM bill",
)
