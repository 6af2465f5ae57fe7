"""The streaming jobs over message files."""

import shutil
from datetime import timezone

from pyspark.sql import functions as F

from tests.helpers import SETTINGS, at, messages, reading, values
from wattledger.operators import consumption, readings
from wattledger.plans import housekeeping
from wattledger.plans.store import Store
from wattledger.sources.readings import source_readings_stream
from wattledger.streaming import speed


def clock():
    return at(100).replace(tzinfo=timezone.utc)


def deliver(spark, store, rows, first_offset=0):
    messages(spark, rows, first_offset).coalesce(1).write.mode("append").parquet(
        f"{store.root}/incoming"
    )


def decoded(spark, store, **options):
    source = source_readings_stream(spark, f"{store.root}/incoming", SETTINGS, options=options)
    return readings.decode_readings(source)


def run_lake(spark, store, **options):
    query = speed.start_lake(decoded(spark, store, **options), store, SETTINGS, clock, True)
    query.awaitTermination()


def run_windows(spark, store, dedup=False):
    query = speed.start_zone_windows(decoded(spark, store), store, SETTINGS, clock, True, dedup)
    query.awaitTermination()


def test_lake_job_writes_all_outputs_and_resumes(spark, folder):
    store = Store(folder)
    deliver(spark, store, [reading("e1", 1.0, used=0.1), reading("e1", 1.0, used=0.1),
                           reading("e2", 2.0, used=0.2), reading("e3", 3.0, grid_zone="X")])
    run_lake(spark, store)
    run_lake(spark, store)
    deliver(spark, store, [reading("e1", 1.0, used=0.1), reading("e4", 301.0)], 10)
    run_lake(spark, store)

    assert values(store.lake(spark), "event_id", "sim_day", "batch_id") == [
        ("e1", 0, 0), ("e1", 0, 1), ("e2", 0, 0), ("e4", 1, 1),
    ]
    assert values(store.quarantine(spark), "event_id", "invalid_reason", "quarantined_at") == [
        ("e3", "unknown_zone", at(100))
    ]
    totals = store.running_totals(spark, SETTINGS)
    assert values(totals, "sim_day", "consumption_kwh", "reading_count") == [(0, 0.4, 3), (1, 1.0, 1)]
    quality = store.quality(spark)
    assert values(quality, "batch_id", "total_events", "clean_events", "invalid_events",
                  "duplicate_events") == [(0, 4, 2, 1, 1), (1, 2, 2, 0, 0)]
    beats = store.heartbeats(spark)
    assert values(beats, "detail") == [("batch_id=1 clean=2 invalid=0 dup=0",)]
    assert store.lake(spark).where("json_str IS NULL").isEmpty()


def test_a_repeated_micro_batch_replaces_itself(spark, folder):
    store = Store(folder)
    rows = [reading(f"e{i}", float(i), household=f"H-{i % 3}") for i in range(20)]
    rows += [reading("bad", 1.0, grid_zone="X")]
    batch = readings.decode_readings(messages(spark, rows))
    for _ in range(3):
        speed.write_lake_batch(batch, 7, store, SETTINGS, clock)
    assert store.lake(spark).count() == 20
    assert store.quarantine(spark).count() == 1
    assert store.quality(spark).count() == 1
    totals = store.running_totals(spark, SETTINGS)
    assert totals.agg(F.sum("reading_count").alias("n")).first().n == 20
    speed.write_lake_batch(batch, 8, store, SETTINGS, clock)
    assert store.lake(spark).count() == 40


def test_an_empty_micro_batch_leaves_no_trace(spark, folder):
    store = Store(folder)
    batch = readings.decode_readings(messages(spark, [reading("e1", 1.0)])).limit(0)
    speed.write_lake_batch(batch, 1, store, SETTINGS, clock)
    assert store.quality(spark).isEmpty()
    assert store.heartbeats(spark).isEmpty()


def test_late_readings_miss_the_windows_but_reach_the_lake(spark, folder):
    store = Store(folder)
    deliver(spark, store, [reading("e1", 10.0), reading("e2", 200.0)])
    run_windows(spark, store)
    run_lake(spark, store)
    # The watermark stands at 140 s: windows ending at or before it are closed.
    deliver(spark, store, [reading("late", 20.0), reading("edge", 130.0), reading("ok", 160.0)], 10)
    run_windows(spark, store)
    run_lake(spark, store)
    counts = dict(values(store.zone_windows(spark), "window_start", "event_count"))
    assert counts == {at(s): 1 for s in (-15, 0, 120, 135, 150, 180, 195)}
    assert values(store.lake(spark), "event_id") == [("e1",), ("e2",), ("edge",), ("late",), ("ok",)]


def test_streamed_windows_equal_batch_windows(spark, folder):
    store = Store(folder)
    first = [reading(f"a{i}", i * 3.0, household=f"H-{i % 5}", zone=SETTINGS.zones[i % 4])
             for i in range(60)]
    second = [reading(f"b{i}", 130 + i * 3.0, zone=SETTINGS.zones[i % 4]) for i in range(60)]
    for part in (first, second):
        deliver(spark, store, part)
        run_windows(spark, store)
    graded = readings.grade_readings(readings.decode_readings(messages(spark, first + second)), SETTINGS)
    batch = consumption.zone_window_metrics(readings.split_clean(graded), SETTINGS)
    names = ("grid_zone", "window_start", "event_count", "total_consumption_kwh", "renewable_pct",
             "household_count")
    assert values(store.zone_windows(spark), *names) == values(batch, *names)


def test_dedup_within_watermark_is_opt_in(spark, folder):
    for dedup, expected in ((False, 3), (True, 2)):
        store = Store(f"{folder}/{dedup}")
        deliver(spark, store, [reading("e1", 10.0), reading("e2", 11.0)])
        run_windows(spark, store, dedup)
        deliver(spark, store, [reading("e1", 10.0)], 10)
        run_windows(spark, store, dedup)
        counts = dict(values(store.zone_windows(spark), "window_start", "event_count"))
        assert counts[at(0)] == expected


def test_rate_limit_makes_one_batch_per_file(spark, folder):
    store = Store(folder)
    for i in range(3):
        deliver(spark, store, [reading(f"e{i}", float(i))], i)
    run_lake(spark, store, maxFilesPerTrigger="1")
    assert values(store.quality(spark), "batch_id", "total_events") == [(0, 1), (1, 1), (2, 1)]


def test_live_readings_join_the_latest_tariff_while_streaming(spark, folder):
    store = Store(folder)
    deliver(spark, store, [reading("e1", 1.0), reading("e2", 2.0, household="H-9")])
    latest = spark.createDataFrame([("H-1", 20.0)], "household_id string, tariff_rate double")
    joined = speed.enrich_live_with_tariff(decoded(spark, store), latest)
    assert joined.isStreaming
    query = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", store.checkpoint_path("live"))
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    assert sorted((r.event_id, r.tariff_rate) for r in got.collect()) == [("e1", 20.0), ("e2", None)]


def test_a_new_checkpoint_loses_and_replaces_nothing(spark, folder):
    store = Store(folder)

    def run(name, rows, fresh):
        messages(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        if fresh:
            shutil.rmtree(f"{folder}/_checkpoints", ignore_errors=True)
        for start in (speed.start_lake, speed.start_zone_windows):
            source = source_readings_stream(spark, f"{folder}/{name}", SETTINGS)
            start(readings.decode_readings(source), store, SETTINGS, clock, True).awaitTermination()

    run("one", [reading("e1", 1.0, used=3.0), reading("x", 2.0, grid_zone="X")], True)
    housekeeping.close_day(spark, store, 0, SETTINGS)
    run("two", [reading("e2", 1.5, used=2.0), reading("y", 2.0, grid_zone="X")], True)
    run("two", [reading("e3", 2.5, used=1.0)], False)
    step = speed.GENERATION_BATCHES
    assert values(store.lake(spark), "event_id", "batch_id") == [("e1", 0), ("e2", step), ("e3", step + 1)]
    assert store.quarantine(spark).count() == 2
    totals = store.running_totals(spark, SETTINGS)
    assert values(totals, "consumption_kwh", "reading_count") == [(6.0, 3)]
    assert store.quality(spark).count() == 3
    # The newest version of a window is the one of the new checkpoint.
    newest = store.zone_windows(spark).where("grid_zone = 'North'").agg({"total_consumption_kwh": "max"})
    assert newest.first()[0] == 3.0
    housekeeping.close_day(spark, store, 0, SETTINGS)
    assert values(store.running_totals(spark, SETTINGS), "consumption_kwh", "reading_count") == [(6.0, 3)]
