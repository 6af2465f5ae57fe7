"""Operators on small inputs, with brute force where rows interact."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import SETTINGS, at, frame, messages, reading, values
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
from wattledger.plans import views

EXTRACT = (
    "household_id string, tariff_rate string, billing_tier string, subsidy_flag string, "
    "sim_day string, published_at string"
)
REFERENCE = (
    "household_id string, sim_day int, tariff_rate double, billing_tier string, subsidy_flag boolean"
)
LOW, STANDARD = "residential_low", "residential_standard"


def clean_rows(spark, rows):
    graded = readings.grade_readings(readings.decode_readings(messages(spark, rows)), SETTINGS)
    return readings.with_sim_day(readings.split_clean(graded), SETTINGS)


def test_hot_copies_collapse_to_the_first_delivery(spark):
    rows = [reading("e1", 1.0, used=1.0 + i) for i in range(40)] + [reading("e2", 2.0)]
    kept = readings.dedup_global(clean_rows(spark, rows))
    assert values(kept, "event_id", "power_consumption_kwh", "offset") == [
        ("e1", 1.0, 0),
        ("e2", 1.0, 40),
    ]


def test_same_event_on_two_days_is_kept_on_both(spark):
    kept = readings.dedup_global(clean_rows(spark, [reading("e1", 1.0), reading("e1", 301.0)]))
    assert values(kept, "event_id", "sim_day") == [("e1", 0), ("e1", 1)]


def test_readings_before_the_epoch_are_dropped(spark):
    assert clean_rows(spark, [reading("e1", -1.0)]).isEmpty()


def test_a_household_in_two_zones_gets_one_row_with_the_latest_zone(spark):
    rows = [
        reading("e1", 1.0, zone="East"),
        reading("e3", 9.0, zone="West"),
        reading("e2", 5.0, zone="North"),
    ]
    day = consumption.household_daily(clean_rows(spark, rows), SETTINGS)
    assert values(day, "household_id", "sim_day", "grid_zone", "reading_count") == [
        ("H-1", 0, "West", 3)
    ]


def test_running_totals_add_batches_and_keep_the_latest_zone(spark):
    lake = clean_rows(
        spark, [reading("e1", 1.0, used=0.1), reading("e2", 2.0, used=0.2, zone="South")]
    ).withColumn("batch_id", F.col("offset"))
    partials = consumption.household_microbatch_totals(lake, SETTINGS)
    total = consumption.running_totals(partials, SETTINGS)
    assert values(total, "consumption_kwh", "reading_count", "grid_zone", "last_event_time") == [
        (0.3, 2, "South", at(2.0))
    ]


def test_sliding_windows(spark):
    windows = consumption.zone_window_metrics(
        clean_rows(spark, [reading("e1", 20.0, used=2.0, made=0.5), reading("e1", 31.0, used=4.0)]),
        SETTINGS,
    )
    got = values(windows, "window_start", "total_consumption_kwh", "event_count", "renewable_pct")
    assert got == [
        (at(0), 2.0, 1, 25.0),
        (at(15), 6.0, 2, 100.0 / 6.0),
        (at(30), 4.0, 1, 12.5),
    ]


def test_quality_counts_add_up(spark):
    rows = [
        reading("e1", 1.0),
        reading("e1", 1.0),
        reading("e2", 2.0, household_id=None),
        reading("e2", 2.0, household_id=None),
        reading("e3", -5.0),
        reading("e4", 3.0, grid_zone="Atlantis"),
    ]
    decoded = readings.decode_readings(messages(spark, rows)).withColumn("batch_id", F.lit(4))
    graded = readings.grade_readings(decoded, SETTINGS)
    kept = readings.dedup_microbatch(readings.split_clean(graded)).withColumn(
        "processed_at", F.lit(at(11)).cast("timestamp")
    )
    row = consumption.microbatch_quality(graded, kept, SETTINGS).first()
    assert (row.total_events, row.clean_events, row.invalid_events) == (6, 1, 3)
    assert (row.duplicate_events, row.out_of_epoch_events) == (2, 1)
    assert row.invalid_by_reason == {"missing_field": 2, "unknown_zone": 1}
    assert (row.avg_lag_seconds, row.max_lag_seconds) == (10.0, 10.0)


def extract(spark, *rows):
    return frame(spark, EXTRACT, *rows)


def test_tariff_validation_and_counters(spark):
    rows = extract(
        spark,
        ("H-1", "20", LOW, "True", "3", "t1"),
        ("H-1", "21", LOW, None, "3", "t2"),
        ("H-2", "-1", LOW, "no", "3", "t1"),
        ("H-2", "-1", LOW, "no", "3", "t1"),
        ("H-3", "20", None, "no", "3", "t1"),
        (None, "20", LOW, "no", "3", "t1"),
        ("H-4", "0", LOW, "no", "3", "t1"),
        ("H-5", "NaN", LOW, "no", "3", "t1"),
        ("H-6", "9", "industrial", "no", "3", "t1"),
    )
    validated = tariffs.validate_tariff(rows, SETTINGS)
    assert values(tariffs.dedup_tariff(validated), "household_id", "tariff_rate", "subsidy_flag") == [
        ("H-1", 21.0, False)
    ]
    stats = tariffs.tariff_stats(validated).first()
    assert (stats.tariff_rows, stats.invalid_tariff_rows, stats.duplicate_tariff_rows) == (9, 7, 1)
    assert tariffs.rejected_tariff_rows(validated).count() == 7


def test_equal_publication_times_do_not_depend_on_row_order(spark):
    rows = [("H-1", str(rate), LOW, "no", "0", "t") for rate in range(10, 40)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        validated = tariffs.validate_tariff(extract(spark, *rows).repartition(4), SETTINGS)
        picks.add(tariffs.dedup_tariff(validated).first().tariff_rate)
    assert picks == {39.0}


def daily_row(spark, *rows):
    ddl = "household_id string, sim_day int, grid_zone string, net_consumption_kwh double"
    return frame(spark, ddl, *rows)


def test_asof_tariff_equals_a_search_over_all_tariffs(spark):
    rng = random.Random(7)
    reference = {
        (f"H-{h}", d): (float(rng.randint(10, 30)), rng.choice([LOW, STANDARD]), rng.random() < 0.5)
        for h in range(12)
        for d in range(20)
        if rng.random() < 0.3
    }
    daily = [(f"H-{h}", d, "North", 1.0) for h in range(14) for d in range(20) if rng.random() < 0.6]
    got = tariffs.asof_tariff(
        daily_row(spark, *daily),
        frame(spark, REFERENCE, *((*key, *value) for key, value in reference.items())),
    )
    want = []
    for household, day, *_ in daily:
        known = [d for h, d in reference if h == household and d <= day]
        best = max(known, default=None)
        source = "missing" if best is None else "current_day" if best == day else "fallback_previous_day"
        rate = None if best is None else reference[household, best][0]
        want.append((household, day, source, rate))
    found = [(r.household_id, r.sim_day, r.tariff_source, r.tariff_rate) for r in got.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_single_day_join_takes_a_whole_tariff(spark):
    reference = frame(
        spark,
        REFERENCE,
        ("H-1", 3, 20.0, LOW, False),
        ("H-1", 2, 25.0, STANDARD, True),
        ("H-2", 1, 30.0, STANDARD, True),
        ("H-2", 0, 31.0, LOW, False),
        ("H-3", 4, 40.0, LOW, True),
    )
    daily = daily_row(spark, *((f"H-{i}", 3, "North", 10.0) for i in (1, 2, 3)))
    joined = tariffs.join_tariff_previous(
        tariffs.join_tariff_today(daily, reference), tariffs.previous_tariffs(reference, 3)
    )
    enriched = tariffs.with_effective_tariff(joined)
    assert sorted(
        (r.household_id, r.tariff_rate, r.billing_tier, r.subsidy_flag, r.tariff_source)
        for r in enriched.collect()
    ) == [
        ("H-1", 20.0, LOW, False, "current_day"),
        ("H-2", 30.0, STANDARD, True, "fallback_previous_day"),
        ("H-3", None, None, None, "missing"),
    ]
    assert values(bills.unbilled_households(enriched), "household_id") == [("H-3",)]


def test_drift(spark):
    rows = frame(spark, "s double, b double", (2244.16, 2241.117), (5.0, 0.0), (0.0, 10.0))
    got = [r.d for r in rows.select(reconciliation.drift_pct(F.col("s"), F.col("b")).alias("d")).collect()]
    assert got[0] == pytest.approx(0.13578, abs=1e-5)
    assert got[1:] == [None, -100.0]


def test_pending_days_skip_empty_and_billed_days(spark):
    lake = frame(spark, "sim_day int", (6,), (8,), (9,))
    billed = frame(spark, "sim_day int", (8,))
    pending = reconciliation.pending_days(spark, lake, billed, 10, SETTINGS)
    assert [r.sim_day for r in pending.collect()] == [9]
    assert reconciliation.pending_days(spark, lake, billed, 0, SETTINGS).isEmpty()


ZONE = (
    "grid_zone string, window_start timestamp, window_end timestamp, "
    "total_consumption_kwh double, total_solar_kwh double, renewable_pct double"
)


def zone(name, start, used, made):
    return (name, at(start), at(start + 30), used, made, min(100.0, 100.0 * made / used))


def test_live_view_prefers_closed_windows_and_alerts_ignore_open_ones(spark):
    rows = frame(spark, ZONE, zone("North", 0, 1.0, 1.0), zone("North", 15, 2.0, 1.0),
                 zone("East", 30, 3.0, 1.0))
    live = grid.latest_complete_window(rows, at(45))
    assert values(live, "grid_zone", "window_start") == [("East", at(30)), ("North", at(15))]
    assert values(grid.latest_closed_window(rows, at(45)), "grid_zone") == [("North",)]
    assert values(audit.audit_zone_coverage(spark, live, SETTINGS), "grid_zone") == [
        ("South",),
        ("West",),
    ]


def test_grid_totals_and_flags(spark):
    rows = frame(spark, ZONE, zone("North", 0, 10.0, 6.0), zone("South", 0, 10.0, 0.5))
    totals = grid.grid_totals(rows, SETTINGS).first()
    assert tuple(totals) == (20.0, 6.5, 32.5)
    night, day = at(30), at(150)
    flagged = views.view_grid_live(rows, day, SETTINGS)
    assert values(flagged, "grid_zone", "below_threshold", "low_renewable") == [
        ("North", False, False),
        ("South", True, True),
    ]
    assert values(views.view_grid_live(rows, night, SETTINGS), "low_renewable") == [(False,)] * 2
    assert tuple(grid.grid_totals(rows.limit(0), SETTINGS).first()) == (0.0, 0.0, 0.0)


def test_history_is_open_at_the_start_and_closed_at_the_end(spark):
    rows = frame(spark, ZONE, *(zone("North", s, 1.0, 0.1) for s in (0, 30, 60, 90)))
    got = views.view_grid_history(rows, at(120), 1)
    assert values(got, "window_end") == [(at(90),), (at(120),)]
    wide = views.view_grid_history(rows, at(120), 1, SETTINGS, wide=True)
    assert wide.columns == ["window_end", "North", "South", "East", "West"]
    with pytest.raises(ValueError):
        views.view_grid_history(rows, at(0), 0)


BEAT = "component string, last_heartbeat timestamp, status string, detail string"


def test_component_states_and_overall_health(spark):
    rows = frame(
        spark,
        BEAT,
        ("speed_layer", at(995), "OK", ""),
        ("meter_producer", at(100), "OK", ""),
        ("batch_layer", at(640), "OK", ""),
        ("batch_layer", at(10), "FAILED", "old"),
        ("tariff_batch_source", at(999), "FAILED", "x"),
    )
    states = health.component_state(rows, at(1000), SETTINGS)
    assert values(states, "component", "status") == [
        ("batch_layer", "OK"),
        ("meter_producer", "STALE"),
        ("speed_layer", "OK"),
        ("tariff_batch_source", "FAILED"),
    ]
    overall = health.health_overall(spark, states, SETTINGS).first()
    assert (overall.status, overall.not_reported_yet) == ("DEGRADED", "alerts_engine")
    good = frame(spark, BEAT, *((c, at(999), "OK", "") for c in SETTINGS.component_budgets))
    states = health.component_state(good, at(1000), SETTINGS)
    assert health.health_overall(spark, states, SETTINGS).first().status == "OK"


def test_rules(spark):
    rows = frame(spark, BEAT, ("speed_layer", at(400), "OK", ""), ("batch_layer", at(640), "OK", ""))
    stale = alerts.rule_no_data(rows, at(1000), SETTINGS)
    assert values(stale, "scope", "breached") == [("batch_layer", False), ("speed_layer", True)]
    message = stale.where("breached").first().message
    assert message == "No heartbeat from speed_layer for 10.0 min (budget 2.0 min)"

    recon = "sim_day int, drift_pct double"
    for drift, breached in ((15.0, True), (-15.0, True), (2.0, False), (None, False)):
        got = alerts.rule_drift(frame(spark, recon, (3, drift), (2, 50.0)), SETTINGS).first()
        assert (got.scope, got.breached) == ("sim_day=3", breached)
    assert alerts.rule_drift(frame(spark, recon).limit(0), SETTINGS).isEmpty()

    for start, pct, breached in ((120, 9.0, True), (120, 11.0, False), (0, 0.0, False)):
        window = ("North", at(start), at(start + 30), 1.0, 0.1, pct)
        got = alerts.rule_low_renewable(frame(spark, ZONE, window), at(290), SETTINGS).first()
        assert got.breached is breached

    arrived = frame(spark, "recorded_at timestamp, total_events bigint", (at(10), 3), (at(100), 0))
    assert alerts.rule_no_events(arrived, at(131)).first().breached
    assert not alerts.rule_no_events(arrived, at(129)).first().breached
    assert alerts.rule_no_events(arrived.limit(0), at(129)).first().breached


def test_quality_rules_without_rows(spark):
    empty = frame(
        spark,
        "batch_id bigint, total_events bigint, clean_events bigint, invalid_events bigint, "
        "duplicate_events bigint, avg_lag_seconds double, max_lag_seconds double, "
        "recorded_at timestamp",
    )
    row = grid.stream_quality_rollup(empty, at(0), SETTINGS).first()
    assert (row.total_events, row.invalid_rate_pct, row.micro_batches) == (0, 0.0, 0)
    assert not alerts.rule_invalid_rate(empty, at(0), SETTINGS).first().breached
    assert not alerts.rule_stream_lag(empty, SETTINGS).first().breached


CANDIDATE = (
    "alert_type string, scope string, severity string, message string, metric_value double, "
    "threshold double, breached boolean"
)


def test_alert_life(spark):
    def candidates(*rows):
        return frame(spark, CANDIDATE, *(("T", s, "WARNING", m, v, t, b) for s, m, v, t, b in rows))

    state = frame(spark, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in alert_schema()))
    history = state
    steps = [
        (at(0), candidates(("a", "m1", 1.0, 5.0, True), ("b", "m", 2.0, 5.0, False)), [("a", "triggered")]),
        (at(10), candidates(("a", "m2", 3.0, 9.0, True)), [("a", "refreshed")]),
        (at(20), candidates(("b", "m3", 2.0, 5.0, True)), [("b", "triggered")]),
        (at(30), candidates(("a", "ok", 0.0, 9.0, False)), [("a", "resolved")]),
        (at(40), candidates(("a", "m4", 7.0, 9.0, True)), [("a", "triggered")]),
    ]
    for when, rows, transitions in steps:
        changes = alerts.alert_lifecycle(state, rows, when)
        changes = spark.createDataFrame(changes.collect(), changes.schema)
        assert values(changes, "scope", "transition") == transitions
        history = history.unionByName(changes.drop("transition"))
        state = alerts.current_alerts(history)
    got = values(state, "scope", "message", "metric_value", "threshold", "triggered_at",
                 "last_seen_at", "resolved")
    assert got == [
        ("a", "m2", 3.0, 5.0, at(0), at(10), True),
        ("a", "m4", 7.0, 9.0, at(40), at(40), False),
        ("b", "m3", 2.0, 5.0, at(20), at(20), False),
    ]
    assert values(alerts.alerts_list(state), "scope") == [("a",), ("b",)]
    assert values(alerts.alerts_list(state, resolved=True), "scope") == [("a",)]
    with pytest.raises(ValueError):
        alerts.alerts_list(state, limit=501)


def alert_schema():
    from wattledger.schemas import ALERT

    return ALERT


@pytest.mark.parametrize("bucket", [7, 60, 10_000])
def test_sustained_breach_does_not_depend_on_buckets(spark, bucket):
    rng = random.Random(11)
    samples, want = [], []
    for series in ("a", "b", "c"):
        spell, now = [], 0
        for _ in range(300):
            now += rng.randint(1, 9)
            breached = rng.random() < 0.85
            samples.append((series, at(now), breached))
            if breached:
                spell.append(now)
            elif spell:
                want.append((series, spell[0], spell[-1], len(spell)))
                spell = []
        if spell:
            want.append((series, spell[0], spell[-1], len(spell)))
    rows = frame(spark, "series string, sampled_at timestamp, breached boolean", *samples)
    got = alerts.sustained_breach(rows.repartition(5), 30, bucket_seconds=bucket)
    assert values(got, "series", "started_at", "ended_at", "samples") == sorted(
        (s, at(a), at(b), n) for s, a, b, n in want if b - a >= 30
    )


@pytest.mark.parametrize("bucket", [7, 60, 100_000])
@pytest.mark.parametrize("gap", [3, 6, None])
def test_spells_end_where_samples_are_missing(spark, bucket, gap):
    rng = random.Random(5)
    samples, want = [], []
    for series in ("a", "b"):
        now, spell = 0, []
        for _ in range(200):
            now += rng.choice((1, 2, 3, 4, 9))
            breached = rng.choice((True, True, True, False, None))
            samples.append((series, at(now), breached))
            if spell and (not breached or (gap is not None and now - spell[-1] > gap)):
                want.append((series, at(spell[0]), at(spell[-1]), len(spell)))
                spell = []
            if breached:
                spell.append(now)
        if spell:
            want.append((series, at(spell[0]), at(spell[-1]), len(spell)))
    rows = frame(spark, "series string, sampled_at timestamp, breached boolean", *samples)
    got = alerts.sustained_breach(rows.repartition(3), 0, bucket, gap_seconds=gap)
    assert values(got, "series", "started_at", "ended_at", "samples") == sorted(want)


def test_arrival_rate_slides(spark):
    rng = random.Random(3)
    came = [(rng.choice("ab"), at(rng.randint(0, 200)), rng.choice((0, 1, 5, None))) for _ in range(150)]
    looked = [(s, at(t)) for s in "abc" for t in (-5, 0, 9, 10, 11, 100, 100, 199, 230)]
    odd = [(None, at(1), 9), ("a", None, 9)]
    arrivals = frame(spark, "series string, at timestamp, events int", *came, *odd)
    samples = frame(spark, "series string, sampled_at timestamp", *looked, (None, at(1)), ("a", None))
    want = sorted(
        (s, t, sum(n or 0 for of, a, n in came if of == s and 0 <= (t - a).total_seconds() < 10))
        for s, t in set(looked)
    )
    got = alerts.arrival_rate(arrivals, samples, 10)
    assert values(got, "series", "sampled_at", "events") == want
    assert all(r.events_per_second == r.events / 10 for r in got.collect())
    assert {r.events for r in alerts.arrival_rate(arrivals.limit(0), samples, 10).collect()} == {0}
    assert alerts.arrival_rate(arrivals, samples.limit(0), 10).isEmpty()


def test_silence_fires_after_its_interval_and_its_hold(spark):
    """Readings until second 600, a look every 30 seconds: silent from 720 on, firing at 840."""
    arrivals = frame(
        spark,
        "label string, at timestamp, events bigint",
        *(("", at(t), 3) for t in range(0, 601, 10)),
    )

    def fired(times):
        looked = frame(spark, "label string, sampled_at timestamp", *(("", at(t)) for t in times))
        samples = alerts.arrival_rate(arrivals, looked, alerts.DELIVERY_SECONDS, "label").select(
            F.lit(alerts.DELIVERY_RATE).alias("name"),
            "label",
            F.col("events_per_second").alias("value"),
            "sampled_at",
        )
        spells = alerts.monitor_alerts(samples, SETTINGS)
        return values(spells, "alert", "started_at", "held_seconds")

    assert fired(range(0, 840, 30)) == []
    assert fired(range(0, 841, 30)) == [("NoMeterEventsProduced", at(720), 120.0)]
    # Nobody looked for longer than the gap that samples may leave: no conclusion.
    assert fired([*range(0, 781, 30), *range(1110, 1200, 30)]) == []


def test_monitor_rules(spark):
    def held(name, label, times, value):
        return [(name, label, value, at(t)) for t in times]

    up, age = "pipeline_component_up", "pipeline_component_staleness_seconds"
    budget = "pipeline_component_stale_budget_seconds"
    rows = [
        *held(up, "a", (0, 30, 60), 0.0),
        *held(up, "b", (0, 30), 0.0),
        *held(up, "b", (45,), 1.0),
        *held(up, "b", (60, 90), 0.0),
        *held(age, "a", (0, 15, 30), 130.0),
        *held(budget, "a", (0, 15, 30), 120.0),
        *held(age, "b", (0, 15, 30), 119.0),
        *held(budget, "b", (0, 15, 30), 120.0),
        *held("batch_reconciliation_drift_pct", "", (0,), -11.0),
        *held("alerts_active", "LOW_RENEWABLE", (0,), 2.0),
        *held("alerts_active", "NO_DATA", (0,), 2.0),
        *held("stream_invalid_event_rate_pct", "", (0, 60, 119), 9.0),
    ]
    samples = frame(spark, "name string, label string, value double, sampled_at timestamp", *rows)
    for bucket in (20, 3600):
        spells = alerts.monitor_alerts(samples, SETTINGS, bucket)
        assert values(spells, "alert", "label", "severity", "held_seconds") == [
            ("LowRenewableContribution", "LOW_RENEWABLE", "WARNING", 0.0),
            ("PipelineComponentStale", "a", "CRITICAL", 30.0),
            ("PipelineComponentUnhealthy", "a", "CRITICAL", 60.0),
            ("ReconciliationDrift", "", "WARNING", 0.0),
        ]


def test_projection(spark):
    running = frame(
        spark,
        "household_id string, sim_day int, grid_zone string, consumption_kwh double, "
        "solar_kwh double, reading_count bigint, last_event_time timestamp",
        ("H-1", 5, "North", 12.0, 2.0, 3, at(1501)),
        ("H-2", 5, "East", 30.008, 4.36, 68, at(1502)),
        ("H-3", 5, "East", 12.0, 2.0, 3, at(1502)),
        ("H-1", 4, "North", 99.0, 0.0, 9, at(1400)),
    )
    reference = frame(spark, REFERENCE, ("H-1", 4, 25.0, LOW, True), ("H-1", 3, 99.0, LOW, False),
                      ("H-2", 4, 26.5, STANDARD, False))
    billed = frame(spark, "household_id string, sim_day int, bill_amount double",
                   ("H-2", 3, 1.0), ("H-2", 4, 2116.32))
    rows = views.view_billing_projection(running, reference, billed, at(1600), SETTINGS)
    got = [
        (r.household_id, r.provisional_bill_so_far, r.status, r.last_final_bill, r.solar_contribution_pct)
        for r in rows.collect()
    ]
    assert got == [
        ("H-1", 212.5, "provisional", None, 16.67),
        ("H-2", 679.67, "provisional", 2116.32, 14.53),
        ("H-3", None, "awaiting_first_tariff", None, 16.67),
    ]
    one = views.view_billing_projection(running, reference, billed, at(1600), SETTINGS, "H-2")
    assert one.count() == 1
    total = bills.billed_total(rows, "provisional_bill_so_far", "total").first()
    assert (total["rows"], total["total"]) == (3, 892.17)


BILL = (
    "household_id string, sim_day int, grid_zone string, total_consumption_kwh double, "
    "total_solar_kwh double, net_consumption_kwh double, solar_contribution_pct double, "
    "tariff_rate double, subsidy_flag boolean, bill_amount double"
)


def test_bill_views(spark):
    rows = frame(
        spark,
        BILL,
        ("H-2", 4, "North", 10.0, 2.0, 8.0, 20.0, 25.0, False, 200.0),
        ("H-1", 4, "North", 10.005, 2.0, 8.005, 19.99, 25.0, False, 200.0),
        ("H-3", 4, "East", 10.0, 2.0, 8.0, 20.0, 25.0, True, 170.02),
        ("H-1", 3, "North", 1.0, 0.0, 1.0, 0.0, 900.0, False, 900.0),
    )
    assert [r.household_id for r in bills.top_bills(bills.bills_of_day(rows), 2).collect()] == [
        "H-1",
        "H-2",
    ]
    summary = views.view_billing_summary(rows, SETTINGS).collect()
    north = next(r for r in summary if r.grid_zone == "North")
    assert (north.households, north.total_billed, north.avg_bill) == (2, 400.0, 200.0)
    assert (north.total_consumption_kwh, north.avg_solar_contribution_pct) == (20.01, 20.0)
    assert values(views.view_billing_daily(rows, 3), "household_id") == [("H-1",)]
    assert values(views.view_billing_daily(rows, household_id="H-3"), "sim_day") == [(4,)]
    wrong = audit.audit_bills(rows, SETTINGS)
    assert values(wrong, "household_id", "sim_day", "expected_amount") == [
        ("H-1", 4, 200.13),
        ("H-3", 4, 170.0),
    ]


@pytest.mark.parametrize(
    "seconds, want",
    [
        (0, (0, 0.0, "00:00", False, 300)),
        (299.999, (0, 1.0, "23:59", False, 300)),
        (300, (1, 0.0, "00:00", False, 300)),
        (3.5 * 300, (3, 0.5, "12:00", True, 300)),
        (300 + 0.25 * 300, (1, 0.25, "06:00", False, 300)),
    ],
)
def test_clock_view(spark, seconds, want):
    rows = views.view_clock(spark, at(seconds), SETTINGS).collect()
    assert [tuple(r) for r in rows] == [want]
    assert list(rows[0].asDict()) == [
        "sim_day", "day_fraction", "sim_time_of_day", "daylight", "simulated_day_seconds",
    ]
