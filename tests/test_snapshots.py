"""Snapshots of the households' state, versions of heartbeats, exact days in hash tables, large amounts."""

import threading
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import EPOCH, SETTINGS, at, frame, messages, reading
from tests.test_billing_run import clock, later, write_tariff
from wattledger import schemas
from wattledger.operators import bills as bill_ops
from wattledger.operators import readings as reading_ops
from wattledger.operators import reconciliation, tariffs
from wattledger.plans import housekeeping, snapshots, views
from wattledger.plans.billing_run import backfill_days, exact_daily, run_day
from wattledger.plans.store import Store
from wattledger.sinks import tables as sinks
from wattledger.sources.readings import source_readings_stream
from wattledger.streaming import speed


def plain(spark, store, day=None):
    """The full aggregate over all committed days."""
    tariff_rows, bills = store.tariffs(spark), store.bills(spark)
    if day is not None:
        tariff_rows, bills = (rows.where(F.col("sim_day") <= day) for rows in (tariff_rows, bills))
    latest = tariffs.latest_tariff_per_household(tariff_rows)
    return latest.join(bill_ops.latest_bill_per_household(bills), "household_id", "full").select(
        *snapshots.STATE.fieldNames()
    )


def rows_of(state):
    return sorted((tuple(r) for r in state.collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    """Five days of three households; H-2 has readings on even days only."""
    rows = [
        reading(f"e{d}-{h}-{i}", d * 300 + i * 20.0, household=f"H-{h}", used=1.0 + h + d)
        for d in range(5) for h in range(3) for i in range(3) if h < 2 or d % 2 == 0
    ]
    target = Store(str(tmp_path / "store"))
    speed.write_lake_batch(reading_ops.decode_readings(messages(spark, rows)), 0, target, SETTINGS, clock)
    return target


def days_of(tmp_path, rate=lambda day, h: 10 + day + h):
    # Day 3 has no tariff for H-0, day 4 none for H-2.
    return {
        d: write_tariff(
            tmp_path, d, *(f"H-{h},{rate(d, h)},residential_low,False" for h in range(3) if (d, h) not in ((3, 0), (4, 2)))
        )
        for d in range(5)
    }


def test_state_follows_commits_and_repeated_bills(spark, store, tmp_path):
    files = days_of(tmp_path)
    assert snapshots.household_state(spark, store).isEmpty()
    backfill_days(spark, store, [(d, files[d]) for d in (0, 1, 2)], "r0", SETTINGS, clock)
    for d in (3, 4):
        run_day(spark, store, d, files[d], f"r{d}", SETTINGS, clock)
        assert rows_of(snapshots.household_state(spark, store)) == rows_of(plain(spark, store))
    newest = {f.rpartition("/")[0] for f in snapshots.household_state(spark, store).inputFiles()}
    assert len(newest) == 1 and "sim_day=4/snapshot=" in newest.pop()
    before = {f.rpartition("/")[0] for f in snapshots.household_state(spark, store, 3).inputFiles()}
    assert len(before) == 1
    # An old day is billed again at other rates: the chain behind it is made anew.
    stale = [link.name for link in snapshots.chain(spark, store)]
    other = write_tariff(tmp_path, 1, "H-0,99,residential_low,True", "H-2,77,residential_low,False")
    run_day(spark, store, 1, other, "again", SETTINGS, later)
    fresh = [link.name for link in snapshots.chain(spark, store)]
    assert [a == b for a, b in zip(stale, fresh)] == [True, False, False, False, False]
    for day in (None, 0, 1, 2, 3, 4):
        assert rows_of(snapshots.household_state(spark, store, day)) == rows_of(plain(spark, store, day))
        assert rows_of(snapshots.take_snapshot(spark, store, day)) == rows_of(plain(spark, store, day))
    dropped = snapshots.sweep_snapshots(spark, store, 2)
    assert len(dropped) >= 4 and all("sim_day=4/snapshot=" + fresh[4] not in d for d in dropped)
    for day in (None, 0, 2, 4):
        assert rows_of(snapshots.household_state(spark, store, day)) == rows_of(plain(spark, store, day))


def test_incomplete_snapshot_is_not_read(spark, store, tmp_path):
    files = days_of(tmp_path)
    backfill_days(spark, store, [(d, files[d]) for d in (0, 1)], "r0", SETTINGS, clock)
    folder = snapshots.Folder(spark, store.household_state_path)
    folder.drop(f"{snapshots.chain(spark, store)[-1].folder}/_SUCCESS")
    assert rows_of(snapshots.household_state(spark, store)) == rows_of(plain(spark, store))
    run_day(spark, store, 2, files[2], "r2", SETTINGS, clock)
    assert rows_of(snapshots.household_state(spark, store)) == rows_of(plain(spark, store))


def test_projection_and_newest_day_read_one_partition(spark, store, tmp_path):
    files = days_of(tmp_path)
    backfill_days(spark, store, [(d, files[d]) for d in (0, 1, 2, 3)], "r0", SETTINGS, clock)
    running = store.running_totals(spark, SETTINGS, [4])
    state = snapshots.household_state(spark, store)
    got = views.view_billing_projection_from(running, state, at(4 * 300 + 200), SETTINGS)
    want = views.view_billing_projection(
        running, store.tariffs(spark), store.bills(spark), at(4 * 300 + 200), SETTINGS
    )
    assert got.collect() == want.collect() and got.count() == 3
    assert all("sim_day=3" in f or "reconciliation" in f for f in store.newest_bills(spark).inputFiles())
    assert reconciliation.newest_billed_day(store.reconciliation(spark)).first()[0] == 3
    daily = views.view_billing_daily(store.newest_bills(spark))
    assert [r.household_id for r in daily.collect()] == ["H-0", "H-1"]


def test_tariff_committed_while_the_feed_runs_shows_in_the_next_batch(spark, store, tmp_path):
    files = days_of(tmp_path)
    folder = str(tmp_path / "incoming")

    def arrive(n):
        rows = [reading(f"live{n}-{h}", 1600.0 + n, household=f"H-{h}") for h in range(2)]
        messages(spark, rows, n * 10).coalesce(1).write.mode("append").parquet(folder)

    arrive(0)
    stream = reading_ops.decode_readings(
        source_readings_stream(spark, folder, SETTINGS, options={"maxFilesPerTrigger": "1"})
    )
    query = speed.start_priced_live(stream, store, SETTINGS.__class__(trigger="1 second"), clock)
    try:
        query.processAllAvailable()
        assert spark.read.parquet(store.priced_live_path).where("tariff_rate IS NOT NULL").isEmpty()
        backfill_days(spark, store, [(d, files[d]) for d in (0, 1)], "r0", SETTINGS, clock)
        arrive(1)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(store.priced_live_path).orderBy("event_id").collect()
    assert [(r.event_id, r.tariff_rate, r.tariff_sim_day) for r in rows] == [
        ("live0-0", None, None), ("live0-1", None, None), ("live1-0", 11.0, 1), ("live1-1", 12.0, 1),
    ]


def beat(spark, component, seconds, status="OK"):
    return frame(spark, schemas.HEARTBEAT, (component, at(seconds), status, f"at {seconds}"))


def test_heartbeats_are_never_gone(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    names = ("speed_layer", "batch_layer")
    for name in names:
        sinks.upsert_heartbeat(beat(spark, name, 0), store.heartbeats_path)
    failures, done = [], threading.Event()

    def watch():
        while not done.is_set():
            seen = {r["component"] for r in store.heartbeats(spark).collect()}
            if seen != set(names):
                failures.append(seen)

    reader = threading.Thread(target=watch)
    reader.start()
    for i in range(1, 26):
        for name in names:
            sinks.upsert_heartbeat(beat(spark, name, i * 30.0), store.heartbeats_path)
        if i % 5 == 0:
            sinks.sweep_heartbeats(spark, store.heartbeats_path, 120)
    done.set()
    reader.join()
    assert not failures
    assert {(r.component, r.detail) for r in store.heartbeats(spark).collect()} == {(n, "at 750.0") for n in names}
    left = snapshots.Folder(spark, store.heartbeats_path).paths("component=speed_layer/version=*")
    assert len(left) == 5
    # An older beat that arrives late does not win.
    sinks.upsert_heartbeat(beat(spark, "speed_layer", 10.0, "FAILED"), store.heartbeats_path)
    assert store.heartbeats(spark).where("status = 'FAILED'").isEmpty()
    housekeeping.sweep(spark, store, SETTINGS)
    assert store.heartbeats(spark).count() == 2


def lake_rows(spark, *rows):
    graded = reading_ops.grade_readings(reading_ops.decode_readings(messages(spark, list(rows))), SETTINGS)
    return reading_ops.with_sim_day(reading_ops.split_clean(graded), SETTINGS)


def test_exact_days_without_sorting_raw_rows(spark):
    rows = [reading(f"e{i % 40}", (i % 40) * 20.0, household=f"H-{i % 3}", used=1.0) for i in range(80)]
    daily = exact_daily(lake_rows(spark, *rows), SETTINGS)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    # The first delivery counts, and an event is one of a household.
    copies = [
        reading("a", 10, used=1.0, zone="North"), reading("a", 20, used=7.0, zone="South"),
        reading("a", 30, household="H-2", used=3.0, zone="West"),
    ]
    got = exact_daily(lake_rows(spark, *copies), SETTINGS).orderBy("household_id").collect()
    assert [(r.household_id, r.grid_zone, r.total_consumption_kwh, r.reading_count) for r in got] == [
        ("H-1", "North", 1.0, 1), ("H-2", "West", 3.0, 1),
    ]


def test_positions_order_by_partition_then_offset(spark):
    first = lake_rows(spark, reading("a", 10, used=1.0)).withColumns(
        {"partition": F.lit(2), "offset": F.lit(5).cast("long")}
    )
    second = lake_rows(spark, reading("a", 10, used=2.0)).withColumns(
        {"partition": F.lit(1), "offset": F.lit((1 << 40) + 3).cast("long")}
    )
    kept = reading_ops.first_measures(first.unionByName(second), SETTINGS).first()
    assert kept["power_consumption_kwh"] == 2.0


def test_one_absurd_rate_does_not_end_the_day(spark, store, tmp_path):
    path = write_tariff(tmp_path, 0, "H-0,1e17,residential_low,False", "H-1,10.5,residential_low,False")
    run_day(spark, store, 0, path, "r0", SETTINGS, clock)
    bills = {r.household_id: r.bill_amount for r in store.bills(spark).collect()}
    assert bills["H-1"] == pytest.approx(4.5 * 10.5, abs=0.011) and bills["H-0"] == pytest.approx(1.5e17)
    metrics = store.reconciliation(spark).first()
    assert metrics.households_billed == 2 and metrics.total_billed == pytest.approx(1.5e17)
    summary = views.view_billing_summary(store.bills(spark), SETTINGS, 0).first()
    assert summary.households == 2 and summary.total_billed == pytest.approx(1.5e17)
    total = bill_ops.billed_total(store.bills(spark).where("household_id = 'H-1'"), "bill_amount", "t").first()["t"]
    assert total == bills["H-1"]


def test_epoch_is_where_the_helpers_put_it():
    assert SETTINGS.epoch_seconds == EPOCH.timestamp() and at(300) - at(0) == timedelta(seconds=300)
