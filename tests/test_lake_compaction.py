"""Compact forms of lake days: every micro-batch is read once, whatever has been folded or dropped."""

import shutil
import time
from datetime import datetime, timedelta, timezone

import pytest

from tests.helpers import SETTINGS, at, messages, reading, values
from wattledger.operators import readings
from wattledger.plans import housekeeping, jobs
from wattledger.plans.billing_run import backfill_days, run_day
from wattledger.plans.store import Store
from wattledger.settings import Settings
from wattledger.sinks import tables as sinks
from wattledger.sources import lake as lake_source
from wattledger.sources.files import Folder
from wattledger.streaming import speed

ROW = ("event_id", "household_id", "power_consumption_kwh", "offset", "event_time", "sim_day", "batch_id")
BILL = ("household_id", "sim_day", "tariff_rate", "bill_amount")


def clock():
    return at(5000).replace(tzinfo=timezone.utc)


def write_batch(spark, store, batch, days=(0, 1)):
    """One micro-batch: a reading of its own per day, and one that all batches deliver again."""
    rows = [reading(f"e{batch}-{d}", d * 300 + batch, household=f"H-{batch % 3}", used=1.0 + batch) for d in days]
    rows += [reading(f"again-{d}", d * 300 + 200, household="H-9") for d in days]
    decoded = readings.decode_readings(messages(spark, rows, batch * 100))
    speed.write_lake_batch(decoded, batch, store, SETTINGS, clock)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    target = Store(str(tmp_path_factory.mktemp("lake") / "store"))
    for batch in range(4):
        write_batch(spark, target, batch)
    return target


@pytest.fixture
def store(filled, tmp_path):
    return Store(str(shutil.copytree(filled.root, tmp_path / "copy")))


def tomorrow():
    return datetime.now(timezone.utc) + timedelta(seconds=SETTINGS.lake_grace_seconds + 60)


def batches(spark, store, day):
    return lake_source.batches_of(Folder(spark, store.lake_path), day)


def sources(rows):
    """Folders that a frame reads, below the lake."""
    return {f.rpartition("/")[0].partition("raw_readings/")[2].partition("-")[0] for f in rows.inputFiles()}


def test_the_newest_batch_stays_loose(spark, store):
    before = values(store.lake(spark), *ROW)
    assert housekeeping.compact_day(spark, store, 0) == 2
    day = lake_source.scan_lake_day(spark, store.lake_path, 0)
    assert sources(day) == {f"_compact/sim_day=0/through={2:020d}", "sim_day=0/batch_id=3"}
    assert values(store.lake(spark), *ROW) == before
    assert values(day, *ROW) == [row for row in before if row[5] == 0]
    assert housekeeping.compact_day(spark, store, 0) is None


def test_late_batches_are_added_and_folded_next_time(spark, store):
    housekeeping.compact_day(spark, store, 0)
    for batch in (4, 5):
        write_batch(spark, store, batch)
    before = values(store.lake(spark, [0]), *ROW)
    assert len(before) == 12 and {row[6] for row in before} == set(range(6))
    assert housekeeping.compact_day(spark, store, 0) == 4
    assert values(store.lake(spark, [0]), *ROW) == before
    assert sources(store.lake(spark, [0])) == {f"_compact/sim_day=0/through={4:020d}", "sim_day=0/batch_id=5"}


def test_a_batch_that_lands_meanwhile_is_read_once(spark, store, monkeypatch):
    real = sinks.compact_day

    def slow(rows, *where):
        write_batch(spark, store, 4)
        real(rows, *where)

    monkeypatch.setattr(sinks, "compact_day", slow)
    assert housekeeping.compact_day(spark, store, 0) == 2
    assert sorted(row[0] for row in values(store.lake(spark, [0]), "batch_id")) == sorted([*range(5)] * 2)


def test_a_folded_batch_written_again_is_not_read_twice(spark, store):
    before = values(store.lake(spark), *ROW)
    housekeeping.compact_day(spark, store, 0)
    write_batch(spark, store, 1)
    assert values(store.lake(spark), *ROW) == before


def test_an_unfinished_form_is_ignored_and_dropped_later(spark, store):
    before = values(store.lake(spark), *ROW)
    housekeeping.compact_day(spark, store, 0)
    folder = Folder(spark, store.lake_path)
    broken = "_compact/sim_day=0/through=00000000000000000001-crashed"
    later = "_compact/sim_day=0/through=00000000000000000009-at-work"
    for name in (broken, later):
        folder.mark(name)
    assert values(store.lake(spark), *ROW) == before
    housekeeping.sweep_lake(spark, store, tomorrow(), SETTINGS)
    assert not folder.exists(broken) and folder.exists(later)
    assert values(store.lake(spark), *ROW) == before


def test_sweep_waits_for_readers(spark, store):
    before = values(store.lake(spark), *ROW)
    planned = store.lake(spark)
    housekeeping.compact_day(spark, store, 0)
    housekeeping.sweep_lake(spark, store, datetime.now(timezone.utc), SETTINGS)
    assert values(planned, *ROW) == before and batches(spark, store, 0) == [0, 1, 2, 3]
    write_batch(spark, store, 4)
    write_batch(spark, store, 5)
    housekeeping.compact_day(spark, store, 0)
    after = values(store.lake(spark), *ROW)
    housekeeping.sweep_lake(spark, store, tomorrow(), SETTINGS)
    assert batches(spark, store, 0) == [5] and batches(spark, store, 1) == [*range(6)]
    assert len(lake_source.all_forms(Folder(spark, store.lake_path), 0)) == 1
    assert values(store.lake(spark), *ROW) == after
    assert values(lake_source.scan_lake_days(spark, store.lake_path), "sim_day") == [(0,), (1,)]


def test_a_day_that_lives_only_in_its_form(spark, store):
    write_batch(spark, store, 4, days=(1,))
    before = values(store.lake(spark), *ROW)
    assert housekeeping.compact_day(spark, store, 0) == 3
    housekeeping.sweep_lake(spark, store, tomorrow(), SETTINGS)
    assert batches(spark, store, 0) == []
    assert values(store.lake(spark), *ROW) == before
    assert len(values(store.lake(spark, [0, 7]), *ROW)) == 8
    with pytest.raises(lake_source.EmptyDayError):
        lake_source.scan_lake_day(spark, store.lake_path, 7)


def test_bills_do_not_depend_on_compaction(spark, store, tmp_path):
    files = []
    for day in (0, 1):
        path = tmp_path / f"tariff_simday{day}.csv"
        lines = "".join(f"H-{h},{20 + h},residential_low,False,{day},2026-01-01T00:00:00\n" for h in (0, 1, 2, 9))
        path.write_text(f"household_id,tariff_rate,billing_tier,subsidy_flag,sim_day,published_at\n{lines}")
        files.append((day, str(path)))
    plain = Store(str(shutil.copytree(store.root, tmp_path / "plain")))
    backfill_days(spark, plain, files, "plain", SETTINGS, clock)
    expected = values(plain.bills(spark), *BILL)
    assert len(expected) == 8
    housekeeping.compact_day(spark, store, 0)
    housekeeping.sweep_lake(spark, store, tomorrow(), SETTINGS)
    again = Store(str(shutil.copytree(store.root, tmp_path / "again")))
    backfill_days(spark, store, files, "all", SETTINGS, clock)
    assert values(store.bills(spark), *BILL) == expected
    for day, file in files:
        run_day(spark, again, day, file, f"r{day}", SETTINGS, clock)
    assert values(again.bills(spark), *BILL) == expected
    columns = ("sim_day", "raw_events", "duplicates_removed", "batch_readings", "speed_readings")
    assert values(again.reconciliation(spark), *columns) == values(plain.reconciliation(spark), *columns)


def test_filters_reach_both_sides_of_a_compacted_day(spark, store):
    housekeeping.compact_day(spark, store, 0)
    query = store.lake(spark).where("sim_day = 1").select("household_id")
    assert {f.partition("sim_day=")[2][0] for f in query.inputFiles()} == {"0", "1"}
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(sim_day") == 2
    assert plan.count("ReadSchema: struct<household_id:string>") == 2


def test_jobs_compact_and_sweep(spark, store):
    before = values(store.lake(spark), *ROW)
    common = ["--store", store.root]
    jobs.main(["compact-day", *common, "--sim-day", "1"], spark)
    assert sources(store.lake(spark, [1])) == {f"_compact/sim_day=1/through={2:020d}", "sim_day=1/batch_id=3"}
    # Day 2 is running: days 0 and 1 are finished, and only day 0 has enough loose batches.
    start = time.time() - 2.5 * SETTINGS.day_seconds
    common += ["--set", f"epoch_seconds={start}", "--set", "compact_batches=3"]
    jobs.main(["compact", *common], spark)
    forms = lake_source.newest_forms(Folder(spark, store.lake_path))
    assert {day: form.through for day, form in forms.items()} == {0: 2, 1: 2}
    assert values(store.lake(spark), *ROW) == before
    settings = Settings(lake_grace_seconds=0)
    housekeeping.sweep_lake(spark, store, tomorrow(), settings)
    assert batches(spark, store, 0) == batches(spark, store, 1) == [3]
    assert values(store.lake(spark), *ROW) == before


def test_nothing_to_compact(spark, tmp_path):
    store = Store(str(tmp_path / "none"))
    assert housekeeping.compact_day(spark, store, 0) is None
    assert housekeeping.compact_lake(spark, store, 3, SETTINGS) == []
    housekeeping.sweep_lake(spark, store, tomorrow(), SETTINGS)
    assert store.lake(spark).count() == store.lake(spark, []).count() == 0
