"""Alert rules and the open / refresh / resolve life of an alert.

Each rule yields candidates (alert_type, scope, severity, message, metric_value, threshold,
breached). A candidate that is not breached closes the open alert of its type and scope; an
alert without a candidate is left as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.functions import clock
from wattledger.functions.clock import instant, seconds_before
from wattledger.functions.exact import fixed_text
from wattledger.operators import grid, health
from wattledger.settings import Settings

WARNING = "WARNING"
CRITICAL = "CRITICAL"
KEY = ("alert_type", "scope")
STATE = (
    "id",
    "alert_type",
    "scope",
    "severity",
    "message",
    "metric_value",
    "threshold",
    "triggered_at",
    "last_seen_at",
    "resolved",
    "resolved_at",
)


def _candidates(
    rows: DataFrame,
    alert_type: str,
    scope: Column,
    severity: str,
    message: Column,
    value: Column,
    threshold: Column,
    breached: Column,
) -> DataFrame:
    return rows.select(
        F.lit(alert_type).alias("alert_type"),
        scope.cast("string").alias("scope"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        value.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold"),
        F.coalesce(breached, F.lit(False)).alias("breached"),
    )


def _plain(value: float) -> Column:
    return F.lit(f"{value:g}")


def rule_low_renewable(windows: DataFrame, as_of, settings: Settings) -> DataFrame:
    """Newest closed window of a zone below the threshold, judged in daylight only."""
    latest = grid.latest_closed_window(windows, as_of)
    pct, limit = F.col("renewable_pct"), settings.low_renewable_pct
    fraction = clock.day_fraction(F.col("window_end"), settings)
    message = F.concat(
        F.lit("Zone "),
        F.col("grid_zone"),
        F.lit(" renewable contribution is "),
        fixed_text(pct, 1),
        F.lit("% (below "),
        _plain(limit),
        F.lit("% during daylight)"),
    )
    breached = clock.is_daylight(fraction, settings) & (pct < limit)
    return _candidates(
        latest,
        "LOW_RENEWABLE",
        F.col("grid_zone"),
        WARNING,
        message,
        pct,
        F.lit(limit),
        breached,
    )


def rule_no_data(heartbeats: DataFrame, as_of, settings: Settings) -> DataFrame:
    """A component silent for longer than its own budget."""
    ages = health.component_ages(heartbeats, as_of, settings)
    age, budget = F.col("age_seconds"), F.col("stale_after_seconds")
    message = F.concat(
        F.lit("No heartbeat from "),
        F.col("component"),
        F.lit(" for "),
        fixed_text(age / F.lit(60.0), 1),
        F.lit(" min (budget "),
        fixed_text(budget / F.lit(60.0), 1),
        F.lit(" min)"),
    )
    return _candidates(
        ages, "NO_DATA", F.col("component"), CRITICAL, message, age, budget, age > budget
    )


def rule_component_failed(heartbeats: DataFrame, as_of) -> DataFrame:
    """A component whose last heartbeat reports anything but OK."""
    reported = heartbeats.where(F.col("last_heartbeat") <= instant(as_of))
    latest = health.latest_heartbeat(reported)
    message = F.concat(
        F.col("component"),
        F.lit(" reported "),
        F.col("status"),
        F.lit(": "),
        F.coalesce("detail", F.lit("None")),
    )
    none = F.lit(None)
    return _candidates(
        latest,
        "COMPONENT_FAILED",
        F.col("component"),
        CRITICAL,
        message,
        none,
        none,
        F.col("status") != "OK",
    )


def rule_invalid_rate(quality: DataFrame, as_of, settings: Settings) -> DataFrame:
    """Share of rejected events among the recent micro-batches."""
    limit = settings.invalid_rate_pct
    rollup = grid.stream_quality_rollup(quality, as_of, settings)
    rate = grid.invalid_rate()
    message = F.concat(
        fixed_text(rate, 1),
        F.lit(f"% of events quarantined in the last {settings.quality_window_seconds // 60} min "),
        F.lit("(threshold "),
        _plain(limit),
        F.lit("%)"),
    )
    breached = (F.col("total_events") > 0) & (rate > limit)
    return _candidates(
        rollup,
        "HIGH_INVALID_RATE",
        F.lit("speed_layer"),
        WARNING,
        message,
        rate,
        F.lit(limit),
        breached,
    )


def rule_stream_lag(quality: DataFrame, settings: Settings) -> DataFrame:
    """Average lag of the newest micro-batches."""
    limit = settings.stream_lag_seconds
    lag = F.col("avg_lag_seconds")
    message = F.concat(
        F.lit("Speed layer is "),
        fixed_text(lag, 0),
        F.lit("s behind event time (threshold "),
        _plain(limit),
        F.lit("s)"),
    )
    return _candidates(
        grid.recent_lag(quality, settings),
        "HIGH_STREAM_LAG",
        F.lit("speed_layer"),
        WARNING,
        F.coalesce(message, F.lit("")),
        lag,
        F.lit(limit),
        lag > limit,
    )


def rule_drift(reconciliation: DataFrame, settings: Settings) -> DataFrame:
    """Drift of the newest reconciled day, in either direction; no drift value, no breach."""
    limit = settings.drift_pct
    newest = reconciliation.orderBy(F.desc("sim_day")).limit(1)
    drift = F.col("drift_pct")
    message = F.concat(
        F.lit("Speed-layer total for day "),
        F.col("sim_day").cast("string"),
        F.lit(" differs from the exact batch total by "),
        F.when(drift >= 0, F.lit("+")).otherwise(F.lit("")),
        fixed_text(drift, 1),
        F.lit("%"),
    )
    return _candidates(
        newest,
        "RECONCILIATION_DRIFT",
        F.concat(F.lit("sim_day="), F.col("sim_day").cast("string")),
        WARNING,
        F.coalesce(message, F.lit("")),
        drift,
        F.lit(limit),
        F.abs(drift) > limit,
    )


TASK_FAILED = "PIPELINE_TASK_FAILED"


def _new_failures(failed: DataFrame, known: DataFrame) -> DataFrame:
    """Failures that no alert of their step has seen yet."""
    seen = known.where(F.col("alert_type") == TASK_FAILED).groupBy("scope").agg(
        F.max("last_seen_at").alias("seen_until")
    )
    scope = F.concat_ws(".", "dag_id", "task_id")
    marked = failed.join(seen, scope == F.col("scope"), "left")
    return marked.where(
        F.col("seen_until").isNull() | (F.col("finished_at") > F.col("seen_until"))
    ).drop("scope", "seen_until")


def rule_task_failed(run_log: DataFrame, as_of, known: DataFrame | None = None) -> DataFrame:
    """Failed step runs up to `as_of`, the last failure of a step speaking for it.

    Only failures become candidates, so such an alert stays open until somebody closes it. With
    the `known` alerts, open and resolved, a failure is a candidate once: a closed alert stays
    closed until the step fails again.
    """
    failed = run_log.where(
        (F.col("state") == "failed") & (F.col("finished_at") <= instant(as_of))
    )
    if known is not None:
        failed = _new_failures(failed, known)
    order = F.struct("finished_at", "sim_day", "error")
    last = failed.groupBy("dag_id", "task_id").agg(
        F.max_by(F.struct("sim_day", "error"), order).alias("last")
    )
    message = F.concat(
        F.lit("Airflow task "),
        F.col("task_id"),
        F.lit(" failed for sim_day="),
        F.coalesce(F.col("last.sim_day").cast("string"), F.lit("None")),
        F.lit(": "),
        F.coalesce(F.col("last.error"), F.lit("None")),
    )
    none = F.lit(None)
    return _candidates(
        last,
        TASK_FAILED,
        F.concat_ws(".", "dag_id", "task_id"),
        CRITICAL,
        message,
        none,
        none,
        F.lit(True),
    )


def rule_no_events(quality: DataFrame, as_of, seconds: float = 120.0) -> DataFrame:
    """No reading arrived within the last `seconds`.

    Quality rows tell arrivals by the time of their micro-batch. Event times would take a burst of
    late readings for silence, and a reading ahead of the clock for life.
    """
    time = F.col("recorded_at")
    recent = quality.where((time > seconds_before(as_of, seconds)) & (time <= instant(as_of)))
    counted = recent.agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("events"))
    message = F.lit(
        f"Streaming source delivered no events in the last {seconds / 60:g} minutes"
    )
    return _candidates(
        counted,
        "NO_METER_EVENTS",
        F.lit("meter_producer"),
        CRITICAL,
        message,
        F.col("events"),
        F.lit(0.0),
        F.col("events") == 0,
    )


def union_candidates(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def sustained_breach(
    samples: DataFrame,
    for_seconds: float,
    bucket_seconds: int = 3600,
    series: str = "series",
    time: str = "sampled_at",
    breached: str = "breached",
    gap_seconds: float | None = None,
) -> DataFrame:
    """Spells during which a condition held without a break, of at least `for_seconds`.

    Without a sample nothing is known: where two samples lie more than `gap_seconds` apart, a
    spell ends at the first and another begins at the second (None: samples are never too far).
    A missing flag counts as not breached.

    One series can hold most samples, so spells are first found per series and time bucket, which
    spreads a series over many tasks. Only the first and the last run of a bucket can continue
    into a neighbour; at most two rows per bucket are then joined up along the series.
    """
    bucket = F.floor(F.unix_micros(F.col(time)) / F.lit(bucket_seconds * 1_000_000))
    flagged = samples.select(
        F.col(series).alias("series"),
        F.col(time).alias("at"),
        F.coalesce(F.col(breached), F.lit(False)).alias("breached"),
        bucket.alias("bucket"),
    )
    in_bucket = Window.partitionBy("series", "bucket").orderBy("at", "breached")
    changed = F.col("breached") != F.lag("breached").over(in_bucket)
    if gap_seconds is not None:
        since = clock.seconds_between(F.lag("at").over(in_bucket), F.col("at"))
        changed = changed | (since > F.lit(float(gap_seconds)))
    numbered = flagged.withColumn("starts", F.coalesce(changed, F.lit(True)))
    numbered = numbered.withColumns(
        {
            "run": F.sum(F.col("starts").cast("int")).over(in_bucket),
            "is_last": F.lead("breached").over(in_bucket).isNull(),
        }
    )
    runs = numbered.groupBy("series", "bucket", "run", "breached").agg(
        F.min("at").alias("started_at"),
        F.max("at").alias("ended_at"),
        F.count(F.lit(1)).alias("samples"),
        (F.bool_or("is_last") | (F.col("run") == 1)).alias("at_edge"),
    )
    inner = runs.where(~F.col("at_edge") & F.col("breached"))
    along = Window.partitionBy("series").orderBy("bucket", "run")
    joined = F.lag("breached").over(along) & (F.lag("bucket").over(along) != F.col("bucket"))
    if gap_seconds is not None:
        since = clock.seconds_between(F.lag("ended_at").over(along), F.col("started_at"))
        joined = joined & (since <= F.lit(float(gap_seconds)))
    edges = runs.where("at_edge").withColumn("continues", F.coalesce(joined, F.lit(False)))
    spells = (
        edges.withColumn("spell", F.sum(F.when(F.col("continues"), 0).otherwise(1)).over(along))
        .where("breached")
        .groupBy("series", "spell")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("ended_at").alias("ended_at"),
            F.sum("samples").alias("samples"),
        )
    )
    columns = ("series", "started_at", "ended_at", "samples")
    length = clock.seconds_between(F.col("started_at"), F.col("ended_at"))
    return (
        inner.select(*columns)
        .unionByName(spells.select(*columns))
        .withColumn("held_seconds", length)
        .where(F.col("held_seconds") >= F.lit(float(for_seconds)))
    )


def arrival_rate(
    arrivals: DataFrame, samples: DataFrame, seconds: int, series: str = "series"
) -> DataFrame:
    """Events per second of a series in the `seconds` up to each sample time: an interval that slides.

    `arrivals` (series, at, events) tell what came in, `samples` (series, sampled_at) when somebody
    looked; an arrival at the sample time counts, one `seconds` earlier doesn't. A series that
    was never sampled has no rate, one that was sampled and received nothing has the rate 0.
    Repeated samples are one; without a series or a time a row says nothing and is left out.

    Time is cut into stretches of the interval's length. An interval ends in the stretch of its
    sample and reaches into the one before, so arrivals go to their own stretch and the next. They
    are summed per instant first, and no task gets more of a series than two stretches.
    """
    micros = seconds * 1_000_000

    def stretch(at: Column) -> Column:
        return at - F.pmod(at, F.lit(micros))

    came = (
        arrivals.where(F.col(series).isNotNull() & F.col("at").isNotNull())
        .groupBy(F.col(series).alias("series"), F.unix_micros("at").alias("at"))
        .agg(F.coalesce(F.sum("events"), F.lit(0)).cast("long").alias("events"))
        .withColumn("stretch", F.explode(F.array(stretch(F.col("at")), stretch(F.col("at")) + micros)))
        .withColumn("is_sample", F.lit(False))
    )
    looked = (
        samples.where(F.col(series).isNotNull() & F.col("sampled_at").isNotNull())
        .select(F.col(series).alias("series"), F.unix_micros("sampled_at").alias("at"))
        .distinct()
        .withColumns(
            {
                "events": F.lit(0).cast("long"),
                "stretch": stretch(F.col("at")),
                "is_sample": F.lit(True),
            }
        )
    )
    sliding = Window.partitionBy("series", "stretch").orderBy("at").rangeBetween(1 - micros, 0)
    return (
        came.unionByName(looked)
        .withColumn("events", F.sum("events").over(sliding))
        .where("is_sample")
        .select(
            F.col("series").alias(series),
            F.timestamp_micros("at").alias("sampled_at"),
            "events",
            (F.col("events") / F.lit(float(seconds))).alias("events_per_second"),
        )
    )


#: Gauge of `arrival_rate` over two minutes.
DELIVERY_RATE, DELIVERY_SECONDS = "meter_events_delivered_rate_2m", 120


def delivery_gauge(quality: DataFrame, as_of) -> DataFrame:
    """The rate of arrivals at `as_of` as a gauge row (name, label, value); 0 if nothing came."""
    arrivals = quality.select(
        F.lit("").alias("label"), F.col("recorded_at").alias("at"), F.col("total_events").alias("events")
    ).where(
        (F.col("at") > seconds_before(as_of, DELIVERY_SECONDS)) & (F.col("at") <= instant(as_of))
    )
    now = quality.sparkSession.range(1).select(F.lit("").alias("label"), instant(as_of).alias("sampled_at"))
    return arrival_rate(arrivals, now, DELIVERY_SECONDS, "label").select(
        F.lit(DELIVERY_RATE).alias("name"), "label", F.col("events_per_second").alias("value")
    )


# Seconds a monitor rule's condition must hold, and its severity.
MONITOR_RULES = {
    "PipelineComponentStale": (30, CRITICAL),
    "PipelineComponentUnhealthy": (60, CRITICAL),
    "NoMeterEventsProduced": (120, CRITICAL),
    "HighInvalidEventRate": (120, WARNING),
    "HighStreamLag": (60, WARNING),
    "ReconciliationDrift": (0, WARNING),
    "LowRenewableContribution": (0, WARNING),
}


def monitor_alerts(samples: DataFrame, settings: Settings, bucket_seconds: int = 3600) -> DataFrame:
    """Spells of the monitor rules over gauge samples (name, label, value, sampled_at).

    The samples are the rows of `pipeline_gauges` and `delivery_gauge` with the time they were
    taken. Samples further apart than `Settings.sample_gap_seconds` don't hold a condition. A rule
    fires when its spell has held; `started_at` is the first sample that was breached, so silence
    of the meters is two minutes old by then.
    """
    value = F.col("value")
    conditions = {
        "pipeline_component_up": ("PipelineComponentUnhealthy", value == 0),
        DELIVERY_RATE: ("NoMeterEventsProduced", value == 0),
        "stream_invalid_event_rate_pct": (
            "HighInvalidEventRate",
            value > settings.invalid_rate_pct,
        ),
        "stream_processing_lag_seconds": ("HighStreamLag", value > settings.stream_lag_seconds),
        "batch_reconciliation_drift_pct": (
            "ReconciliationDrift",
            F.abs(value) > settings.drift_pct,
        ),
        "alerts_active": ("LowRenewableContribution", value > 0),
    }
    wanted = (F.col("name") != "alerts_active") | (F.col("label") == "LOW_RENEWABLE")
    rule = F.coalesce(
        *(F.when(F.col("name") == g, F.lit(alert)) for g, (alert, _) in conditions.items())
    )
    breached = F.coalesce(
        *(F.when(F.col("name") == g, holds) for g, (_, holds) in conditions.items())
    )
    single = samples.where(F.col("name").isin(*conditions) & wanted).select(
        rule.alias("alert"), "label", "sampled_at", breached.alias("breached")
    )

    def gauge(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, value))

    age, budget = "pipeline_component_staleness_seconds", "pipeline_component_stale_budget_seconds"
    stale = (
        samples.where(F.col("name").isin(age, budget))
        .groupBy("label", "sampled_at")
        .agg((gauge(age) > gauge(budget)).alias("breached"))
        .withColumn("alert", F.lit("PipelineComponentStale"))
    )
    flagged = single.unionByName(stale).withColumn("series", F.struct("alert", "label"))
    spells = sustained_breach(
        flagged, 0, bucket_seconds, gap_seconds=settings.sample_gap_seconds
    )

    def of_rule(part: int) -> Column:
        return F.coalesce(
            *(
                F.when(F.col("series.alert") == alert, F.lit(rule[part]))
                for alert, rule in MONITOR_RULES.items()
            )
        )

    return spells.where(F.col("held_seconds") >= of_rule(0)).select(
        "series.alert",
        "series.label",
        of_rule(1).alias("severity"),
        "started_at",
        "ended_at",
        "samples",
        "held_seconds",
    )


def alert_merge(open_alerts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Open alerts next to the candidates of their type and scope, from both sides.

    `action` is insert, refresh, resolve or keep; clear candidates without an open alert vanish.
    """
    current = open_alerts.where(~F.col("resolved")).select(
        *KEY, F.struct(*(c for c in STATE if c not in KEY)).alias("open")
    )
    incoming = candidates.select(
        *KEY, F.struct(*(c for c in candidates.columns if c not in KEY)).alias("seen")
    )
    action = (
        F.when(F.col("open").isNull() & F.col("seen.breached"), F.lit("insert"))
        .when(F.col("seen.breached"), F.lit("refresh"))
        .when(F.col("open").isNotNull() & F.col("seen").isNotNull(), F.lit("resolve"))
        .when(F.col("open").isNotNull(), F.lit("keep"))
    )
    merged = current.join(incoming, list(KEY), "full").withColumn("action", action)
    return merged.where(F.col("action").isNotNull())


def alert_lifecycle(open_alerts: DataFrame, candidates: DataFrame, as_of) -> DataFrame:
    """The rows a rule pass changes, with the transition: triggered, refreshed or resolved.

    A refresh takes over message and value; the time of the first trigger, the severity and the
    threshold stay.
    """
    now = instant(as_of)
    is_new = F.col("action") == "insert"
    is_resolved = F.col("action") == "resolve"

    def kept(name: str) -> Column:
        return F.when(is_new, F.col(f"seen.{name}")).otherwise(F.col(f"open.{name}"))

    def renewed(name: str) -> Column:
        return F.when(is_resolved, F.col(f"open.{name}")).otherwise(F.col(f"seen.{name}"))

    changed = alert_merge(open_alerts, candidates).where(F.col("action") != "keep")
    triggered_at = F.when(is_new, now).otherwise(F.col("open.triggered_at"))
    return changed.select(
        F.when(is_new, F.xxhash64(*KEY, now)).otherwise(F.col("open.id")).alias("id"),
        *KEY,
        kept("severity").alias("severity"),
        renewed("message").alias("message"),
        renewed("metric_value").alias("metric_value"),
        kept("threshold").alias("threshold"),
        triggered_at.alias("triggered_at"),
        F.when(is_resolved, F.col("open.last_seen_at")).otherwise(now).alias("last_seen_at"),
        is_resolved.alias("resolved"),
        F.when(is_resolved, now).alias("resolved_at"),
        F.when(is_new, F.lit("triggered"))
        .when(is_resolved, F.lit("resolved"))
        .otherwise(F.lit("refreshed"))
        .alias("transition"),
    )


def with_closures(candidates: DataFrame, open_alerts: DataFrame, closures: DataFrame) -> DataFrame:
    """Candidates, and a clear one for every open alert that somebody closed after it was last seen.

    `closures` has id and closed_at. A breached candidate of the same type and scope counts more.
    """
    closed = closures.groupBy("id").agg(F.max("closed_at").alias("closed_at"))
    asked = open_alerts.where(~F.col("resolved")).join(closed, "id").where(F.col("closed_at") > F.col("last_seen_at"))
    clear = asked.select(
        *KEY, "severity", "message", "metric_value", "threshold", F.lit(False).alias("breached")
    )
    judged = candidates.where("breached").select(*KEY)
    left = clear.join(judged, list(KEY), "left_anti")
    others = candidates.join(left.select(*KEY), list(KEY), "left_anti")
    return others.unionByName(left)


def open_after(open_alerts: DataFrame, changes: DataFrame) -> DataFrame:
    """The open alerts after a pass: those it left alone and those it triggered or refreshed."""
    changed = changes.where("NOT resolved").select(*STATE)
    untouched = open_alerts.where(~F.col("resolved")).select(*STATE).join(changes.select("id"), "id", "left_anti")
    return untouched.select(*STATE).unionByName(changed)


def current_alerts(changes: DataFrame) -> DataFrame:
    """The present state of every alert from the log of changes."""
    payload = [c for c in STATE if c != "id"]
    newest = F.max_by(F.struct(*payload), F.struct("resolved", "last_seen_at")).alias("newest")
    return changes.groupBy("id").agg(newest).select("id", "newest.*")


def alerts_list(alerts: DataFrame, resolved: bool = False, limit: int = 50) -> DataFrame:
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    chosen = alerts.where(F.col("resolved") == resolved)
    return chosen.orderBy(F.desc("triggered_at"), *KEY).limit(limit)
