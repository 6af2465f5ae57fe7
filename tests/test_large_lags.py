"""A micro-batch that catches up on many old readings: its lag, and where it is cached."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tests.helpers import SETTINGS, at, messages, reading
from wattledger.operators import consumption, readings
from wattledger.plans.store import Store
from wattledger.sinks import tables as sinks
from wattledger.streaming import speed


def quality(spark, seconds, processed_micros):
    rows = messages(spark, [reading(f"e{i}", at_second) for i, at_second in enumerate(seconds)])
    decoded = readings.decode_readings(rows).withColumn("batch_id", F.lit(4))
    graded = readings.grade_readings(decoded, SETTINGS)
    kept = readings.split_clean(graded).withColumn("processed_at", F.timestamp_micros(F.lit(processed_micros)))
    return consumption.microbatch_quality(graded, kept, SETTINGS).first()


def test_lags_of_a_batch_may_exceed_a_bigint_of_micros(spark):
    row = quality(spark, [1.0] * 3, 4 * 10**18)
    assert row.clean_events == 3
    assert row.avg_lag_seconds == row.max_lag_seconds > 3.9e12


def test_lags_before_and_after_the_start_of_processing_are_added_exactly(spark):
    start = int(at(5).timestamp()) * 1_000_000
    row = quality(spark, [1.25, 4.500001, 9.75], start)
    assert row.avg_lag_seconds == (3_750_000 + 499_999 - 4_750_000) / 3 / 1e6
    assert row.max_lag_seconds == 3.75


def test_a_batch_is_cached_on_disk(spark, folder, monkeypatch):
    before, held = set(spark.sparkContext._jsc.getPersistentRDDs()), []
    append = sinks.append_stream_quality

    def look(quality, path):
        cached = spark.sparkContext._jsc.getPersistentRDDs()
        held.extend(cached[i].getStorageLevel() for i in cached if i not in before)
        append(quality, path)

    monkeypatch.setattr(sinks, "append_stream_quality", look)
    decoded = readings.decode_readings(messages(spark, [reading("e1", 1.0), reading("e2", 2.0)]))
    speed.write_lake_batch(decoded, 0, Store(folder), SETTINGS, lambda: datetime.now(timezone.utc))
    assert len(held) == 2
    assert all(level.useDisk() and not level.useMemory() for level in held)
    assert Store(folder).lake(spark).count() == 2
