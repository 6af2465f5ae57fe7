"""SQL counterparts of the registered queries, written for DuckDB.

`CTE` holds the shared steps; `sql` prepends the ones a statement needs. Sums and bills use
decimals here and whole units in Spark, the fallback is an as-of join here and a carried window
there, so the two sides do not share their method.
"""

from __future__ import annotations

import re

from verification.inputs import AS_OF, EARLIER, SETTINGS

EPOCH_US = SETTINGS.epoch_micros
DAY_US = SETTINGS.day_micros
ZONES = "('North'), ('South'), ('East'), ('West')"


def half_up(value: str, digits: int) -> str:
    """One rounding of the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def text(value: str, digits: int) -> str:
    kind = f"DECIMAL(37,{digits})" if digits else "BIGINT"
    rounded = f"round(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits})"
    return f"CAST(CAST({rounded} AS {kind}) AS VARCHAR)"


def moment(as_of: str) -> str:
    return f"TIMESTAMP '{as_of}'"


def fraction(time: str) -> str:
    return f"CAST((epoch_us({time}) - {EPOCH_US}) % {DAY_US} AS DOUBLE) / {float(DAY_US)}"


def daylight(frac: str) -> str:
    return f"({frac}) BETWEEN {SETTINGS.daylight_start}::DOUBLE AND {SETTINGS.daylight_end}::DOUBLE"


RENEWABLE = (
    "CASE WHEN {c} > 0 THEN least(100.0::DOUBLE, 100.0::DOUBLE * {s} / {c}) ELSE 0.0::DOUBLE END"
)


def window_sql(source: str, extra: str = "") -> str:
    """Sliding windows of 30 minutes every 15 over clean rows."""
    return f"""
    SELECT grid_zone, window_start, window_start + INTERVAL 30 MINUTE AS window_end,
           CAST(c AS DOUBLE) / n AS avg_consumption_kwh, CAST(s AS DOUBLE) / n AS avg_solar_kwh,
           CAST(c AS DOUBLE) AS total_consumption_kwh, CAST(s AS DOUBLE) AS total_solar_kwh,
           {RENEWABLE.format(c='CAST(c AS DOUBLE)', s='CAST(s AS DOUBLE)')} AS renewable_pct,
           n AS event_count, h AS exact_households
    FROM (SELECT grid_zone,
                 make_timestamp((epoch_us(event_time) // 900000000 - k) * 900000000) AS window_start,
                 sum(CAST(power_consumption_kwh AS DECIMAL(18,6))) AS c,
                 sum(CAST(solar_generation_kwh AS DECIMAL(18,6))) AS s,
                 count(*) AS n, count(DISTINCT household_id) AS h
          FROM {source} CROSS JOIN (VALUES (0), (1)) w(k) {extra}
          GROUP BY 1, 2)"""


PCT = half_up(
    "CASE WHEN {c} > 0 THEN 100.0::DOUBLE * least({s}, {c}) / {c} ELSE 0 END", 2
)


def pct(c: str, s: str) -> str:
    return PCT.format(c=c, s=s)


def bill(net: str, rate: str, flag: str) -> str:
    left = f"(1.0::DOUBLE - CASE WHEN {flag} THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END / 100.0::DOUBLE)"
    return half_up(f"CAST({net} AS DOUBLE) * CAST({rate} AS DOUBLE) * {left}", 2)


def drift(speed: str, batch: str) -> str:
    return f"CASE WHEN {batch} <> 0 THEN 100.0::DOUBLE * ({speed} - {batch}) / {batch} END"


def _latest(source: str, key: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


CTE: dict[str, str] = {
    "reading": f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, 'M-' || user_id AS meter_id,
           CASE WHEN event_id % 101 <> 7 THEN 'H-' || user_id END AS household_id,
           CASE WHEN event_id % 109 = 7 THEN -value ELSE value END AS power_consumption_kwh,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4 AS solar_generation_kwh,
           CASE WHEN event_id % 107 = 7 THEN 'Atlantis'
                ELSE ['North','South','East','West'][user_id % 4 + 1] END AS grid_zone,
           CASE WHEN event_id % 103 = 7 THEN 'not-a-timestamp'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS "timestamp",
           CAST(user_id % 3 AS INTEGER) AS "partition", event_id * 2 + redelivery AS "offset",
           (epoch_us(ts) - {EPOCH_US}) // 3600000000
             + CASE WHEN redelivery = 1 AND event_id % 100 = 53 THEN 1 ELSE 0 END AS batch_id,
           CASE WHEN event_id % 103 <> 7 THEN ts END AS event_time,
           redelivery, event_id AS n
    FROM events CROSS JOIN (VALUES (0), (1)) r(redelivery)
    WHERE redelivery = 0 OR event_id % 50 = 3""",
    "graded": f"""
    SELECT *, CASE
        WHEN household_id IS NULL THEN 'missing_field'
        WHEN event_time IS NULL THEN 'bad_timestamp'
        WHEN grid_zone NOT IN ('North','South','East','West') THEN 'unknown_zone'
        WHEN power_consumption_kwh < 0 OR solar_generation_kwh < 0 THEN 'negative_value'
        WHEN power_consumption_kwh > 50 OR solar_generation_kwh > 50 THEN 'out_of_range'
        END AS invalid_reason,
        CAST((epoch_us(event_time) - {EPOCH_US}) // {DAY_US} AS INTEGER) AS sim_day
    FROM reading""",
    "clean": "SELECT * FROM graded WHERE invalid_reason IS NULL AND sim_day >= 0",
    "lake": _latest("clean", "batch_id, event_id", '"partition", "offset"'),
    "exact": _latest("clean", "sim_day, event_id", '"partition", "offset"'),
    "partial": """
    SELECT batch_id, household_id, sim_day, grid_zone,
           CAST(sum(CAST(power_consumption_kwh AS DECIMAL(18,6))) AS DOUBLE) AS consumption_kwh,
           CAST(sum(CAST(solar_generation_kwh AS DECIMAL(18,6))) AS DOUBLE) AS solar_kwh,
           count(*) AS reading_count, max(event_time) AS last_event_time
    FROM lake GROUP BY 1, 2, 3, 4""",
    "running": """
    SELECT household_id, sim_day, arg_max(grid_zone, event_time) AS grid_zone,
           CAST(sum(CAST(power_consumption_kwh AS DECIMAL(18,6))) AS DOUBLE) AS consumption_kwh,
           CAST(sum(CAST(solar_generation_kwh AS DECIMAL(18,6))) AS DOUBLE) AS solar_kwh,
           count(*) AS reading_count, max(event_time) AS last_event_time
    FROM lake GROUP BY 1, 2""",
    "daily": f"""
    SELECT household_id, sim_day, grid_zone, CAST(c AS DOUBLE) AS total_consumption_kwh,
           CAST(s AS DOUBLE) AS total_solar_kwh,
           CAST(greatest(c - s, 0) AS DOUBLE) AS net_consumption_kwh,
           CAST(greatest(s - c, 0) AS DOUBLE) AS solar_export_kwh,
           {pct('CAST(c AS DOUBLE)', 'CAST(s AS DOUBLE)')} AS solar_contribution_pct,
           peak_reading_kwh, reading_count
    FROM (SELECT household_id, sim_day, arg_max(grid_zone, event_time) AS grid_zone,
                 sum(CAST(power_consumption_kwh AS DECIMAL(18,6))) AS c,
                 sum(CAST(solar_generation_kwh AS DECIMAL(18,6))) AS s,
                 max(power_consumption_kwh) AS peak_reading_kwh, count(*) AS reading_count
          FROM exact GROUP BY 1, 2)""",
    "tariff_raw": """
    SELECT 'H-' || c AS household_id,
           CASE WHEN v = 1 THEN CAST(base + 1 AS VARCHAR) WHEN (c + d) % 11 = 0 THEN ''
                WHEN (c + d) % 13 = 0 THEN '-1' WHEN (c + d) % 83 = 5 THEN '1000000000'
                WHEN (c + d) % 89 = 5 THEN '0.0000004' WHEN (c + d) % 97 = 5 THEN '18.3712345' ELSE CAST(base AS VARCHAR) END AS raw_rate,
           CASE WHEN c % 4 = 1 THEN 'residential_standard' WHEN c % 4 = 2 THEN 'residential_high'
                WHEN c % 4 = 3 AND d % 10 = 9 THEN 'industrial'
                ELSE 'residential_low' END AS billing_tier,
           c % 7 = 0 AS subsidy_flag, CAST(d AS INTEGER) AS sim_day,
           '2024-01-' || lpad(CAST(d + 2 AS VARCHAR), 2, '0')
             || CASE WHEN v = 1 THEN 'T06:00:00+00:00' ELSE 'T00:30:00+00:00' END AS published_at
    FROM (SELECT c_custkey AS c, d, v, 15 + (c_custkey * 7 + d * 3) % 20 AS base
          FROM customer CROSS JOIN range(0, 30) r(d) CROSS JOIN (VALUES (0), (1), (2)) i(v)
          WHERE c_custkey % 29 <> 5 AND (v = 0 OR (v = 1 AND c_custkey % 17 = 3)
                                         OR (v = 2 AND c_custkey % 19 = 4)))""",
    "tariff_row": """
    SELECT *, TRY_CAST(raw_rate AS DOUBLE) AS tariff_rate,
           coalesce(TRY_CAST(raw_rate AS DOUBLE) > 0 AND billing_tier IN
             ('residential_low', 'residential_standard', 'residential_high'), FALSE) AS is_valid
    FROM tariff_raw""",
    "tariff_ref": """
    SELECT household_id, sim_day, tariff_rate, billing_tier, subsidy_flag FROM tariff_row
    WHERE is_valid
    QUALIFY row_number() OVER (PARTITION BY household_id, sim_day ORDER BY published_at DESC,
        tariff_rate DESC, billing_tier DESC, subsidy_flag DESC) = 1""",
    "enriched": """
    SELECT d.*, t.tariff_rate, t.billing_tier, t.subsidy_flag, t.sim_day AS tariff_sim_day,
           CASE WHEN t.sim_day = d.sim_day THEN 'current_day'
                WHEN t.sim_day IS NOT NULL THEN 'fallback_previous_day'
                ELSE 'missing' END AS tariff_source
    FROM daily d ASOF LEFT JOIN tariff_ref t
      ON d.household_id = t.household_id AND d.sim_day >= t.sim_day""",
    "bill": f"""
    SELECT household_id, sim_day, grid_zone, total_consumption_kwh, total_solar_kwh,
           net_consumption_kwh, solar_export_kwh, solar_contribution_pct, tariff_rate,
           billing_tier, subsidy_flag,
           CASE WHEN subsidy_flag THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END AS subsidy_discount_pct,
           tariff_source, {bill('net_consumption_kwh', 'tariff_rate', 'subsidy_flag')} AS bill_amount
    FROM enriched WHERE tariff_source <> 'missing'""",
    "recon_days": f"""
    SELECT sim_day, coalesce(sk, 0) AS speed_consumption_kwh, coalesce(bk, 0) AS batch_consumption_kwh,
           {drift('coalesce(sk, 0)', 'coalesce(bk, 0)')} AS drift_pct,
           CAST(coalesce(sr, 0) AS BIGINT) AS speed_readings,
           CAST(coalesce(br, 0) AS BIGINT) AS batch_readings
    FROM (SELECT sim_day, CAST(sum(CAST(consumption_kwh AS DECIMAL(18,6))) AS DOUBLE) AS sk,
                 sum(reading_count) AS sr FROM running GROUP BY 1) speed
    FULL JOIN (SELECT sim_day, CAST(sum(CAST(total_consumption_kwh AS DECIMAL(18,6))) AS DOUBLE) AS bk,
                 sum(reading_count) AS br FROM daily GROUP BY 1) batch USING (sim_day)""",
    "tariff_stat": """
    SELECT sim_day, count(*) AS tariff_rows, count(*) FILTER (NOT is_valid) AS invalid_tariff_rows,
           count(*) FILTER (is_valid) - count(DISTINCT CASE WHEN is_valid THEN household_id END)
             AS duplicate_tariff_rows
    FROM tariff_row GROUP BY 1""",
    "recon": """
    SELECT r.*, raw.n AS raw_events, raw.n - r.batch_readings AS duplicates_removed,
           coalesce(t.tariff_rows, 0) AS tariff_rows,
           coalesce(t.invalid_tariff_rows, 0) AS invalid_tariff_rows,
           coalesce(t.duplicate_tariff_rows, 0) AS duplicate_tariff_rows,
           coalesce(b.fallback, 0) AS fallback_tariffs, coalesce(b.n, 0) AS households_billed,
           d.n - coalesce(b.n, 0) AS households_unbilled,
           coalesce(b.total, 0.0::DOUBLE) AS total_billed
    FROM recon_days r
    JOIN (SELECT sim_day, count(*) AS n FROM daily GROUP BY 1) d USING (sim_day)
    JOIN (SELECT sim_day, count(*) AS n FROM lake GROUP BY 1) raw USING (sim_day)
    LEFT JOIN tariff_stat t USING (sim_day)
    LEFT JOIN (SELECT sim_day, count(*) AS n,
                      count(*) FILTER (tariff_source = 'fallback_previous_day') AS fallback,
                      CAST(sum(CAST(bill_amount AS DECIMAL(18,2))) AS DOUBLE) AS total
               FROM bill GROUP BY 1) b USING (sim_day)""",
    "zone_window": window_sql("clean"),
    "window_now": window_sql("clean", f"WHERE event_time <= {moment(AS_OF)}"),
    "window_early": window_sql("clean", f"WHERE event_time <= {moment(EARLIER)}"),
    "quality": f"""
    SELECT a.batch_id, a.total_events, coalesce(k.n, 0) AS clean_events, a.invalid_events,
           a.total_events - a.invalid_events - coalesce(k.n, 0) AS duplicate_events,
           k.lag_sum / k.n / 1e6 AS avg_lag_seconds, k.lag_max / 1e6 AS max_lag_seconds,
           make_timestamp({EPOCH_US} + 30000000 + (a.batch_id + 1) * 3600000000) AS recorded_at
    FROM (SELECT batch_id, count(*) AS total_events,
                 count(invalid_reason) AS invalid_events FROM graded GROUP BY 1) a
    LEFT JOIN (SELECT batch_id, count(*) AS n, CAST(sum(lag) AS DOUBLE) AS lag_sum,
                      CAST(max(lag) AS DOUBLE) AS lag_max
               FROM (SELECT batch_id, {EPOCH_US} + 30000000 + (batch_id + 1) * 3600000000
                            - epoch_us(event_time) AS lag FROM lake) GROUP BY 1) k USING (batch_id)""",
    "reason": """
    SELECT batch_id, invalid_reason, count(*) AS events FROM graded
    WHERE invalid_reason IS NOT NULL GROUP BY 1, 2""",
    "heartbeat": """
    SELECT ['meter_producer','tariff_batch_source','speed_layer','batch_layer'][event_id % 4 + 1]
             AS component, ts AS last_heartbeat,
           CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'OK' END AS status,
           'event ' || event_id AS detail
    FROM events""",
    "step_run": f"""
    SELECT 'daily_batch' AS dag_id, event_type AS task_id, ts AS finished_at,
           CAST((epoch_us(ts) - {EPOCH_US}) // {DAY_US} AS INTEGER) AS sim_day,
           'exit code ' || event_id % 7 AS error
    FROM events WHERE event_type = 'error' OR value > 300""",
}


def _as_of_ctes(suffix: str, as_of: str, last_day: int) -> None:
    """Rules as seen at a moment; `suffix` tells the two passes apart."""
    now = moment(as_of)
    s = SETTINGS
    CTE[f"beat_{suffix}"] = f"""
    SELECT *, CAST(epoch_us({now}) - epoch_us(last_heartbeat) AS DOUBLE) / 1e6 AS age_seconds,
           CASE WHEN component = 'batch_layer' THEN {2 * s.day_seconds + s.no_data_seconds}::DOUBLE
                ELSE {s.no_data_seconds}::DOUBLE END AS stale_after_seconds
    FROM heartbeat WHERE last_heartbeat <= {now}
    QUALIFY row_number() OVER (PARTITION BY component
        ORDER BY last_heartbeat DESC, status DESC, detail DESC) = 1"""
    CTE[f"closed_{suffix}"] = _latest(
        f"(SELECT * FROM window_{suffix} WHERE window_end <= {now})",
        "grid_zone",
        "window_start DESC",
    )
    start = f"{now} - INTERVAL {s.quality_window_seconds} SECOND"
    CTE[f"rollup_{suffix}"] = f"""
    SELECT CAST(coalesce(sum(total_events), 0) AS BIGINT) AS total_events,
           CAST(coalesce(sum(clean_events), 0) AS BIGINT) AS clean_events,
           CAST(coalesce(sum(invalid_events), 0) AS BIGINT) AS invalid_events,
           CAST(coalesce(sum(duplicate_events), 0) AS BIGINT) AS duplicate_events,
           {half_up('avg(avg_lag_seconds)', 2)} AS avg_lag_seconds,
           max(max_lag_seconds) AS max_lag_seconds, count(*) AS micro_batches,
           CASE WHEN sum(total_events) > 0
                THEN 100.0::DOUBLE * CAST(sum(invalid_events) AS BIGINT)
                     / CAST(sum(total_events) AS BIGINT) ELSE 0.0::DOUBLE END AS rate
    FROM quality WHERE recorded_at > {start} AND recorded_at <= {now}"""
    CTE[f"lag_{suffix}"] = f"""
    SELECT avg(avg_lag_seconds) AS lag
    FROM (SELECT avg_lag_seconds FROM quality WHERE recorded_at <= {now}
          ORDER BY recorded_at DESC, batch_id DESC LIMIT {s.lag_batches})"""
    CTE[f"newest_{suffix}"] = f"""
    SELECT * FROM recon WHERE sim_day <= {last_day} ORDER BY sim_day DESC LIMIT 1"""
    frac = fraction("window_end")
    CTE[f"rules_{suffix}"] = f"""
    SELECT 'LOW_RENEWABLE' AS alert_type, grid_zone AS scope, 'WARNING' AS severity,
           'Zone ' || grid_zone || ' renewable contribution is ' || {text('renewable_pct', 1)}
             || '% (below {s.low_renewable_pct:g}% during daylight)' AS message,
           renewable_pct AS metric_value, {s.low_renewable_pct}::DOUBLE AS threshold,
           {daylight(frac)} AND renewable_pct < {s.low_renewable_pct}::DOUBLE AS breached
    FROM closed_{suffix}
    UNION ALL
    SELECT 'NO_DATA', component, 'CRITICAL',
           'No heartbeat from ' || component || ' for ' || {text('age_seconds / 60', 1)}
             || ' min (budget ' || {text('stale_after_seconds / 60', 1)} || ' min)',
           age_seconds, stale_after_seconds, age_seconds > stale_after_seconds FROM beat_{suffix}
    UNION ALL
    SELECT 'COMPONENT_FAILED', component, 'CRITICAL',
           component || ' reported ' || status || ': ' || detail, NULL, NULL, status <> 'OK'
    FROM beat_{suffix}
    UNION ALL
    SELECT 'HIGH_INVALID_RATE', 'speed_layer', 'WARNING',
           {text('rate', 1)} || '% of events quarantined in the last {s.quality_window_seconds // 60} min '
             || '(threshold {s.invalid_rate_pct:g}%)', rate, {s.invalid_rate_pct}::DOUBLE,
           total_events > 0 AND rate > {s.invalid_rate_pct}::DOUBLE FROM rollup_{suffix}
    UNION ALL
    SELECT 'HIGH_STREAM_LAG', 'speed_layer', 'WARNING',
           coalesce('Speed layer is ' || {text('lag', 0)} || 's behind event time (threshold '
             || '{s.stream_lag_seconds:g}s)', ''), lag, {s.stream_lag_seconds}::DOUBLE,
           coalesce(lag > {s.stream_lag_seconds}::DOUBLE, FALSE) FROM lag_{suffix}
    UNION ALL
    SELECT 'RECONCILIATION_DRIFT', 'sim_day=' || sim_day, 'WARNING',
           coalesce('Speed-layer total for day ' || sim_day || ' differs from the exact batch total by '
             || CASE WHEN drift_pct >= 0 THEN '+' ELSE '' END || {text('drift_pct', 1)} || '%', ''),
           drift_pct, {s.drift_pct}::DOUBLE,
           coalesce(abs(drift_pct) > {s.drift_pct}::DOUBLE, FALSE) FROM newest_{suffix}
    UNION ALL
    SELECT 'PIPELINE_TASK_FAILED', dag_id || '.' || task_id, 'CRITICAL',
           'Airflow task ' || task_id || ' failed for sim_day=' || sim_day || ': ' || error,
           NULL, NULL, TRUE
    FROM (SELECT * FROM step_run WHERE finished_at <= {now}
          QUALIFY row_number() OVER (PARTITION BY dag_id, task_id
              ORDER BY finished_at DESC, sim_day DESC, error DESC) = 1)"""


_as_of_ctes("early", EARLIER, 27)
_as_of_ctes("now", AS_OF, 28)

CTE["open_early"] = f"""
    SELECT *, {moment(EARLIER)} AS triggered_at, {moment(EARLIER)} AS last_seen_at
    FROM rules_early WHERE breached"""
CTE["changes"] = f"""
    SELECT alert_type, scope, coalesce(o.severity, r.severity) AS severity,
           CASE WHEN r.breached THEN r.message ELSE o.message END AS message,
           CASE WHEN r.breached THEN r.metric_value ELSE o.metric_value END AS metric_value,
           CASE WHEN o.scope IS NULL THEN r.threshold ELSE o.threshold END AS threshold,
           coalesce(o.triggered_at, {moment(AS_OF)}) AS triggered_at,
           CASE WHEN r.breached THEN {moment(AS_OF)} ELSE o.last_seen_at END AS last_seen_at,
           NOT r.breached AS resolved,
           CASE WHEN NOT r.breached THEN {moment(AS_OF)} END AS resolved_at,
           CASE WHEN NOT r.breached THEN 'resolved' WHEN o.scope IS NULL THEN 'triggered'
                ELSE 'refreshed' END AS transition
    FROM rules_now r LEFT JOIN open_early o USING (alert_type, scope)
    WHERE r.breached OR o.scope IS NOT NULL"""
CTE["alert"] = """
    SELECT alert_type, scope, severity, message, metric_value, threshold, triggered_at,
           last_seen_at, resolved, resolved_at FROM changes
    UNION ALL
    SELECT alert_type, scope, severity, message, metric_value, threshold, triggered_at,
           last_seen_at, FALSE, NULL
    FROM open_early o
    WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.alert_type = o.alert_type AND c.scope = o.scope)"""
CTE["state"] = f"""
    SELECT component, CASE WHEN status <> 'OK' THEN 'FAILED'
                           WHEN age_seconds > stale_after_seconds THEN 'STALE' ELSE 'OK' END AS status,
           {half_up('age_seconds', 1)} AS age_seconds, stale_after_seconds, detail, last_heartbeat
    FROM beat_now"""
CTE["live_window"] = _latest(
    "window_now", "grid_zone", f"(window_end <= {moment(AS_OF)}) DESC, window_start DESC"
)


def sql(statement: str) -> str:
    """The statement with every shared step it uses, directly or not."""
    needed: set[str] = set()
    pending = [statement]
    while pending:
        part = pending.pop()
        for name in CTE:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", part):
                needed.add(name)
                pending.append(CTE[name])
    names = [name for name in CTE if name in needed]
    if not names:
        return statement
    steps = ",\n".join(f"{name} AS ({CTE[name]})" for name in names)
    return f"WITH {steps}\n{statement}"
