"""Billing runs against a store, tariff files, reports and the command line."""

import random
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.helpers import EPOCH, SETTINGS, at, messages, reading, values
from wattledger.operators import alerts as alert_ops
from wattledger.operators import bills as bill_ops
from wattledger.operators import readings
from wattledger.plans import alert_pass, housekeeping, jobs, report
from wattledger.plans.billing_run import backfill_days, run_day
from wattledger.plans.store import Store
from wattledger.schemas import LAKE
from wattledger.sinks import tables as sinks
from wattledger.sources import lake as lake_source
from wattledger.sources import tariff_files
from wattledger.sources.files import Folder
from wattledger.streaming import speed

HEADER = "household_id,tariff_rate,billing_tier,subsidy_flag,sim_day,published_at\n"


def clock():
    return at(5000).replace(tzinfo=timezone.utc)


def later():
    return at(6000).replace(tzinfo=timezone.utc)


def write_tariff(folder, day, *rows):
    path = folder / f"tariff_simday{day}.csv"
    path.write_text(HEADER + "".join(f"{r},{day},2026-01-01T00:00:00+00:00\n" for r in rows))
    (folder / f"_SUCCESS_simday{day}").write_text(f"{path.name}\n")
    return str(path)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """Three days, four households, two readings delivered in two micro-batches."""
    rng = random.Random(3)
    rows = [
        reading(f"e{d}-{h}-{i}", d * 300 + i * 20.0, household=f"H-{h}",
                used=round(rng.uniform(0, 3), 3), made=round(rng.uniform(0, 2), 3),
                zone=SETTINGS.zones[h])
        for d in range(3) for h in range(4) for i in range(10)
    ]
    target = Store(str(tmp_path_factory.mktemp("filled") / "store"))
    batch = readings.decode_readings(messages(spark, rows))
    speed.write_lake_batch(batch, 0, target, SETTINGS, clock)
    again = readings.decode_readings(messages(spark, rows[:2], 1000))
    speed.write_lake_batch(again, 1, target, SETTINGS, clock)
    return target


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    folder = tmp_path_factory.mktemp("drop")
    low = "residential_low,False"
    write_tariff(folder, 0, f"H-0,20,{low}", "H-1,21,residential_high,True", f"H-2,22,{low}")
    write_tariff(folder, 1, f"H-0,,{low}", f"H-0,,{low}", f"H-1,-1,{low}", f"H-2,23,{low}")
    write_tariff(folder, 2, f"H-0,24,{low}", f"H-0,24,{low}")
    (folder / "_SUCCESS_simday7").write_text("absent.csv\n")
    return folder


@pytest.fixture(scope="module")
def billed(spark, filled, drop, tmp_path_factory):
    target = copied(filled, tmp_path_factory.mktemp("billed"))
    bill_each_day(spark, target, drop)
    return target


def copied(source, folder):
    return Store(str(shutil.copytree(source.root, folder / "copy")))


@pytest.fixture
def store(filled, tmp_path):
    """A fresh copy of the filled store."""
    return copied(filled, tmp_path)


@pytest.fixture
def billed_copy(billed, tmp_path):
    return copied(billed, tmp_path)


BILL = ("household_id", "sim_day", "tariff_rate", "tariff_source", "bill_amount")


def expected(lake):
    """Bills by plain Python over the lake rows."""
    from decimal import ROUND_HALF_UP, Decimal

    tariffs = {0: {"H-0": 20, "H-1": 21, "H-2": 22}, 1: {"H-2": 23}, 2: {"H-0": 24}}
    seen, totals = set(), {}
    for r in lake.orderBy("offset").collect():
        if (r.event_id, r.sim_day) in seen:
            continue
        seen.add((r.event_id, r.sim_day))
        used, made = totals.get((r.household_id, r.sim_day), (Decimal(0), Decimal(0)))
        totals[r.household_id, r.sim_day] = (
            used + Decimal(str(r.power_consumption_kwh)),
            made + Decimal(str(r.solar_generation_kwh)),
        )
    out = []
    for (household, day), (used, made) in totals.items():
        known = [d for d in range(day + 1) if household in tariffs[d]]
        if not known:
            continue
        rate = tariffs[known[-1]][household]
        factor = Decimal("0.85") if household == "H-1" else Decimal(1)
        amount = (max(used - made, Decimal(0)) * rate * factor).quantize(Decimal("0.01"), ROUND_HALF_UP)
        source = "current_day" if known[-1] == day else "fallback_previous_day"
        out.append((household, day, float(rate), source, float(amount)))
    return sorted(out)


def bill_each_day(spark, store, drop, run="r"):
    for day in range(3):
        run_day(spark, store, day, str(drop / f"tariff_simday{day}.csv"), f"{run}{day}", SETTINGS, clock)


def test_day_by_day_runs(spark, billed):
    store = billed
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))
    assert values(store.unbilled(spark), "household_id", "sim_day") == [("H-3", d) for d in range(3)]
    rows = {r.sim_day: r for r in store.reconciliation(spark).collect()}
    first, second, third = rows[0], rows[1], rows[2]
    assert (first.raw_events, first.duplicates_removed, first.batch_readings) == (42, 2, 40)
    assert first.speed_readings == 42 and first.drift_pct > 0
    assert (second.tariff_rows, second.invalid_tariff_rows, second.duplicate_tariff_rows) == (4, 3, 0)
    assert (second.fallback_tariffs, second.households_billed, second.households_unbilled) == (2, 3, 1)
    assert (third.tariff_rows, third.duplicate_tariff_rows, third.drift_pct) == (2, 1, 0.0)
    assert store.tariff_rows(spark).where("NOT is_valid AND sim_day = 1").count() == 3
    beats = store.heartbeats(spark).where("component = 'batch_layer'")
    assert values(beats, "status", "detail") == [("OK", "sim_day=2 run_id=r2")]


def test_backfill_equals_day_by_day(spark, store, drop):
    ready = values(tariff_files.scan_ready_days(spark, str(drop)), "sim_day", "path")
    assert [day for day, _ in ready] == [0, 1, 2]
    backfill_days(spark, store, ready, "all", SETTINGS, clock)
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))
    assert store.reconciliation(spark).count() == 3


def test_tariffs_are_looked_up_once_for_bills_and_unbilled(spark, store, drop, monkeypatch):
    looked = []
    unbilled = bill_ops.unbilled_households
    monkeypatch.setattr(bill_ops, "unbilled_households", lambda rows: looked.append(rows) or unbilled(rows))
    was = []
    compute = bill_ops.compute_bills
    monkeypatch.setattr(
        bill_ops, "compute_bills", lambda rows, settings: was.append(rows.is_cached) or compute(rows, settings)
    )
    ready = values(tariff_files.scan_ready_days(spark, str(drop)), "sim_day", "path")
    backfill_days(spark, store, ready, "all", SETTINGS, clock)
    assert was == [True] and not looked[0].is_cached
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))


def test_tariff_rows_are_written_without_a_shuffle(spark, store, drop, monkeypatch):
    balanced = {}
    write = sinks.replace_partitions

    def look(rows, path, keys, balance=True):
        balanced[path] = balance
        write(rows, path, keys, balance)

    monkeypatch.setattr(sinks, "replace_partitions", look)
    ready = values(tariff_files.scan_ready_days(spark, str(drop)), "sim_day", "path")
    backfill_days(spark, store, ready, "all", SETTINGS, clock)
    assert not balanced[store.tariff_rows_path] and balanced[store.tariffs_path]
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))


def test_day_of_a_tariff_file_is_looked_up_by_its_path(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    (folder / "parts").mkdir(parents=True)
    (folder / "parts" / "part-0.csv").write_text(HEADER + "H-1,20,residential_low,False,9,t\n")
    (folder / "one.csv").write_text(HEADER + "H-2,21,residential_low,False,9,t\nH-3,21,residential_low,False,,t\n")
    ready = [(3, str(folder / "parts")), (4, str(folder / "one.csv"))]
    rows = tariff_files.scan_tariff_files(spark, ready)
    assert rows.columns == tariff_files.scan_tariff_csv(spark, *(p for _, p in ready)).columns
    assert values(rows, "household_id", "sim_day") == [("H-1", "3"), ("H-2", "4"), ("H-3", "4")]
    assert "BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()


def test_every_listed_tariff_file_finds_its_day(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    (folder / "one.csv").write_text(HEADER + "H-2,21,residential_low,False,9,t\n")
    ready = {tariff_files._bare(str(folder / "one.csv")): 4}
    rows = tariff_files.scan_tariff_csv(spark, str(folder / "one.csv"))
    known = dict(tariff_files._days_of_files(rows.inputFiles(), ready))
    seen = rows.select(F.col("_metadata.file_path").alias("path")).first().path
    assert known.get(seen) == "4"


def test_backfill_falls_back_to_stored_tariffs(spark, store, drop):
    ready = values(tariff_files.scan_ready_days(spark, str(drop)), "sim_day", "path")
    backfill_days(spark, store, ready[:1], "first", SETTINGS, clock)
    backfill_days(spark, store, ready[1:], "rest", SETTINGS, clock)
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))


def test_reruns_replace_a_day_and_unfinished_runs_stay_hidden(spark, billed_copy, drop, tmp_path):
    store = billed_copy
    before = values(store.bills(spark), *BILL)
    run_day(spark, store, 1, str(drop / "tariff_simday1.csv"), "r1", SETTINGS, clock)
    assert values(store.bills(spark), *BILL) == before

    file = write_tariff(tmp_path, 2, "H-0,30,residential_low,False")
    unfinished = store.bills(spark).where("sim_day = 2").drop("run_id")
    sinks.replace_day(unfinished.withColumn("bill_amount", F.lit(0.0)), store.bills_path, "crashed")
    assert values(store.bills(spark), *BILL) == before

    run_day(spark, store, 2, file, "again", SETTINGS, later)
    after = values(store.bills(spark).where("sim_day = 2"), "household_id", "tariff_rate", "run_id")
    assert after == [("H-0", 30.0, "again"), ("H-1", 21.0, "again"), ("H-2", 23.0, "again")]
    assert store.reconciliation(spark).count() == 3


def test_an_empty_day_is_an_error_and_reported(spark, store, drop):
    file = str(drop / "tariff_simday0.csv")
    with pytest.raises(lake_source.EmptyDayError):
        run_day(spark, store, 9, file, "r", SETTINGS, clock)
    beat = store.heartbeats(spark).where("component = 'batch_layer'").first()
    assert beat.status == "FAILED" and "sim_day=9" in beat.detail


def test_lake_day_lists_only_its_folder(spark, filled):
    store = filled
    day = lake_source.scan_lake_day(spark, store.lake_path, 1)
    assert values(day.select("sim_day").distinct(), "sim_day") == [(1,)]
    assert all("sim_day=1/" in f for f in day.inputFiles())
    assert values(lake_source.scan_lake_days(spark, store.lake_path), "sim_day") == [(0,), (1,), (2,)]


def test_lake_scan_prunes_partitions_and_columns(spark, filled):
    store = filled
    query = store.lake(spark).where("sim_day = 1").groupBy("household_id").count()
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sim_day" in plan
    assert "ReadSchema: struct<household_id:string>" in plan


def test_compacted_day_keeps_its_rows(spark, store):
    day = store.lake(spark, [0]).persist()
    names = ("event_id", "offset", "batch_id")
    before = values(day, *names)
    for _ in range(2):
        sinks.compact_day(day, store.lake_path, 0, 1)
        assert values(store.lake(spark, [0]), *names) == before


def test_report_files(spark, billed, tmp_path):
    store = billed
    out = str(tmp_path / "reports")
    report.write_report(store.bills(spark), 1, out)
    lines = spark.read.option("header", True).csv(f"{out}/sim_day=1")
    assert tuple(lines.columns) == sinks.REPORT_COLUMNS
    assert [r.household_id for r in lines.collect()] == ["H-0", "H-1", "H-2"]
    with pytest.raises(RuntimeError):
        report.write_report(store.bills(spark), 9, out)
    parts = report.report_day(store.bills(spark), store.reconciliation(spark), 1, SETTINGS)
    assert parts["kpis"].first().households_billed == 3
    assert parts["reconciliation"].count() == 1
    assert parts["top_bills"].count() == 3


def test_alert_passes_over_the_store(spark, billed_copy):
    store = billed_copy
    first = alert_pass.run_alert_pass(spark, store, at(9000), 1, SETTINGS)
    opened = values(first, "alert_type", "scope", "transition")
    assert ("NO_DATA", "speed_layer", "triggered") in opened
    again = alert_pass.run_alert_pass(spark, store, at(9000), 1, SETTINGS)
    assert values(again, "alert_type", "scope", "transition") == opened
    second = alert_pass.run_alert_pass(spark, store, at(9010), 2, SETTINGS)
    assert ("NO_DATA", "speed_layer", "refreshed") in values(second, "alert_type", "scope", "transition")
    assert bill_ops.latest_billed_day(store.bills(spark)).first().sim_day == 2


def test_command_line(spark, store, drop, tmp_path):
    argument = ["--store", store.root]
    jobs.main(["bill-day", *argument, "--sim-day", "0", "--tariff-file",
               str(drop / "tariff_simday0.csv")], spark)
    epoch_now = speed.utc_now().timestamp() - 3 * 300 - 10
    setting = ["--set", f"epoch_seconds={epoch_now}"]
    jobs.main(["backfill", *argument, *setting, "--tariff-folder", str(drop)], spark)
    jobs.main(["alerts", *argument, "--pass-id", "1"], spark)
    jobs.main(["report", *argument, "--sim-day", "0", "--out", str(tmp_path / "out")], spark)
    assert values(store.bills(spark), *BILL) == expected(store.lake(spark))
    assert (tmp_path / "out" / "sim_day=0").is_dir()
    assert EPOCH.timestamp() == SETTINGS.epoch_seconds


def test_speed_command_reads_message_files(spark, tmp_path):
    messages(spark, [reading("e1", 1.0)]).write.parquet(str(tmp_path / "in"))
    jobs.main(["speed", "--store", str(tmp_path / "s"), "--topic", str(tmp_path / "in"),
               "--format", "parquet", "--available-now"], spark)
    target = Store(str(tmp_path / "s"))
    assert target.lake(spark).count() == 1
    assert target.zone_windows(spark).count() == 2


def test_closed_days_and_expired_batches(spark, store, tmp_path):
    names = ("household_id", "sim_day", "consumption_kwh", "reading_count", "grid_zone")
    before = values(store.running_totals(spark, SETTINGS), *names)
    for _ in range(2):
        housekeeping.close_day(spark, store, 0, SETTINGS)
    assert values(store.running_totals(spark, SETTINGS), *names) == before
    assert len(values(store.running_totals(spark, SETTINGS, [0]), *names)) == 4

    late = readings.decode_readings(messages(spark, [reading("late", 5.0, household="H-0", used=2.0)]))
    speed.write_lake_batch(late, 2, store, SETTINGS, clock)
    counts = dict(values(store.running_totals(spark, SETTINGS, [0]), "household_id", "reading_count"))
    assert counts["H-0"] == dict((h, n) for h, d, _, n, _ in before if d == 0)["H-0"] + 1
    housekeeping.close_day(spark, store, 0, SETTINGS)
    again = dict(values(store.running_totals(spark, SETTINGS, [0]), "household_id", "reading_count"))
    assert again == counts

    housekeeping.expire_live(spark, store, at(5000 + 6 * 3600), SETTINGS)
    assert store.quality(spark).count() == 3
    housekeeping.expire_live(spark, store, at(5001 + 6 * 3600), SETTINGS)
    assert store.quality(spark).isEmpty()


def test_backfill_skips_tariffs_of_days_without_readings(spark, tmp_path):
    rows = [reading(f"e{d}", d * 300 + 5.0, household="H-0", used=2.0, made=0.0) for d in (0, 2)]
    low = "residential_low,False"
    drop = tmp_path / "drop"
    drop.mkdir()
    files = {
        0: write_tariff(drop, 0, f"H-0,10,{low}"),
        1: write_tariff(drop, 1, f"H-0,20,{low}"),
        2: write_tariff(drop, 2, f"H-9,30,{low}"),
    }
    bills = []
    for name in ("daily", "backfill"):
        target = Store(str(tmp_path / name))
        speed.write_lake_batch(readings.decode_readings(messages(spark, rows)), 0, target, SETTINGS, clock)
        if name == "daily":
            for day, file in files.items():
                try:
                    run_day(spark, target, day, file, f"r{day}", SETTINGS, clock)
                except lake_source.EmptyDayError:
                    assert day == 1
        else:
            backfill_days(spark, target, sorted(files.items()), "all", SETTINGS, clock)
        bills.append(values(target.bills(spark), *BILL))
        assert values(target.tariffs(spark), "sim_day") == [(0,), (2,)]
        assert values(target.newest_bills(spark), "sim_day") == [(2,)]
    assert bills[0] == bills[1]
    assert bills[0][-1] == ("H-0", 2, 10.0, "fallback_previous_day", 20.0)


def test_a_batch_that_lands_while_a_day_is_closed_counts_once(spark, tmp_path, monkeypatch):
    target = Store(str(tmp_path / "store"))

    def deliver(number, used):
        rows = [reading(f"e{number}", 5.0, used=used)]
        speed.write_lake_batch(readings.decode_readings(messages(spark, rows)), number, target, SETTINGS, clock)

    deliver(0, 2.0)
    totals = Store.running_totals

    def interrupted(self, *args):
        monkeypatch.setattr(Store, "running_totals", totals)
        deliver(1, 5.0)
        return self.running_totals(*args)

    monkeypatch.setattr(Store, "running_totals", interrupted)
    housekeeping.close_day(spark, target, 0, SETTINGS)
    assert values(target.running_totals(spark, SETTINGS), "consumption_kwh", "reading_count") == [(7.0, 2)]


def test_expiry_never_brings_an_old_version_back(spark, tmp_path):
    target = Store(str(tmp_path / "store"))
    window = "grid_zone string, window_start timestamp, total_consumption_kwh double"
    for number, rows in enumerate(
        ([("North", at(0), 5.0), ("North", at(40_000), 1.0)], [("North", at(0), 9.0)])
    ):
        sinks.upsert_zone_windows(
            spark.createDataFrame(rows, window), target.zone_windows_path, number, F.lit(at(40_000))
        )
    housekeeping.expire_live(spark, target, at(50_000), SETTINGS)
    # The hour of the first window is gone with all versions, the other one stays.
    kept = target.zone_windows(spark)
    assert values(kept, "window_start", "total_consumption_kwh") == [(at(40_000), 1.0)]


def test_ready_days_open_wanted_markers_only(spark, drop):
    assert values(tariff_files.scan_ready_days(spark, str(drop), {1, 7}), "sim_day") == [(1,)]


def test_work_folder_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from wattledger import session

    class Cluster:
        conf = spark.conf

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    if spark.conf.get(session.CHECKPOINT_DIR, None) is None:
        with pytest.raises(ValueError, match="share"):
            session.work_folder(Cluster, "x")


def test_a_failed_run_raises_its_alert(spark, store, drop):
    with pytest.raises(lake_source.EmptyDayError):
        run_day(spark, store, 9, str(drop / "tariff_simday0.csv"), "r9", SETTINGS, clock)
    run_day(spark, store, 0, str(drop / "tariff_simday0.csv"), "r0", SETTINGS, clock)
    assert values(store.run_log(spark), "task_id", "sim_day", "state") == [
        ("bill_day", 0, "success"), ("bill_day", 9, "failed"),
    ]
    alert_pass.run_alert_pass(spark, store, at(5100), 1, SETTINGS)
    failed = store.alerts(spark).where("alert_type = 'PIPELINE_TASK_FAILED' AND NOT resolved")
    assert values(failed, "scope") == [("billing.bill_day",)]


def test_stored_gauge_samples_feed_the_monitor(spark, store, drop):
    run_day(spark, store, 0, str(drop / "tariff_simday0.csv"), "r0", SETTINGS, clock)
    for seconds in (100_000, 100_060, 100_120):
        alert_pass.sample_gauges(spark, store, at(seconds), SETTINGS)
    samples = store.gauge_samples(spark, at(100_000))
    assert samples.select("sampled_at").distinct().count() == 3
    found = alert_ops.monitor_alerts(samples, SETTINGS)
    stale = found.where("alert = 'PipelineComponentStale'")
    assert ("batch_layer", 120.0) in values(stale, "label", "held_seconds")
    assert store.gauge_samples(spark, at(200_000)).isEmpty()
    # Nobody produces any more at that time.
    assert values(found.where("alert = 'NoMeterEventsProduced'"), "started_at", "held_seconds") == [
        (at(100_000), 120.0)
    ]


def test_superseded_and_abandoned_runs_are_swept(spark, filled, drop, tmp_path):
    target = copied(filled, tmp_path)
    tables = (target.daily_path, target.tariff_rows_path, target.tariffs_path, target.bills_path)

    def runs(day):
        return [
            sorted(name.partition("=")[2] for name in Folder(spark, path).names(f"sim_day={day}/run_id=*"))
            for path in tables
        ]

    ready = [(day, str(drop / f"tariff_simday{day}.csv")) for day in (0, 1)]
    backfill_days(spark, target, ready, "first", SETTINGS, clock)
    run_day(spark, target, 0, ready[0][1], "second", SETTINGS, later)
    before = values(target.bills(spark), "sim_day", "household_id", "bill_amount")
    # A run that failed half-way, and one whose commit is younger than the grace period.
    sinks.replace_day(target.daily(spark).drop("run_id").where("sim_day = 1"), target.daily_path, "failed")
    assert housekeeping.sweep_runs(spark, target, at(6000 + SETTINGS.grace_seconds - 1), SETTINGS) == []

    assert housekeeping.sweep_runs(spark, target, at(6000 + SETTINGS.grace_seconds), SETTINGS) == [(0, "first")]
    assert runs(0) == [["second"]] * 4
    assert runs(1) == [["failed", "first"], *[["first"]] * 3]
    much_later = datetime.now(timezone.utc) + timedelta(seconds=SETTINGS.abandoned_seconds + 60)
    assert housekeeping.sweep_runs(spark, target, much_later, SETTINGS) == [(1, "failed")]
    assert runs(1) == [["first"]] * 4
    assert values(target.bills(spark), "sim_day", "household_id", "bill_amount") == before
    assert housekeeping.sweep_runs(spark, Store(str(tmp_path / "none")), at(0), SETTINGS) == []
