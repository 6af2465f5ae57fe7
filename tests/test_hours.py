"""Live logs kept by hour: what is listed, what expires, repeated micro-batches."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import SETTINGS, at, frame, values
from wattledger import schemas
from wattledger.functions.clock import hour_of
from wattledger.operators import grid
from wattledger.plans import housekeeping, views
from wattledger.plans.store import Store
from wattledger.sinks import tables as sinks

HOUR = 3600


@pytest.fixture
def store(spark, tmp_path):
    """A window of each zone every 10 minutes and a quality row every 5, over ten hours."""
    target = Store(str(tmp_path / "store"))
    starts = spark.range(60).select(F.timestamp_seconds(F.lit(hour_of(at(0)) * HOUR) + F.col("id") * 600).alias("window_start"))
    windows = starts.crossJoin(frame(spark, "grid_zone string", *((z,) for z in SETTINGS.zones))).select(
        "grid_zone", "window_start", (F.col("window_start") + F.expr("INTERVAL 30 SECONDS")).alias("window_end"),
        *(F.lit(1.0).alias(c) for c in ("avg_consumption_kwh", "avg_solar_kwh", "total_consumption_kwh", "total_solar_kwh", "renewable_pct")),
        F.lit(1).cast("long").alias("event_count"), F.lit(1).cast("long").alias("household_count"),
    )
    for number in (0, 1):
        newer = windows.withColumn("total_consumption_kwh", F.lit(1.0 + number))
        sinks.upsert_zone_windows(newer, target.zone_windows_path, number, F.lit(at(0)))
    quality = spark.range(120).select(
        *(F.lit(1).cast("long").alias(c) for c in ("total_events", "clean_events", "invalid_events", "duplicate_events", "out_of_epoch_events")),
        F.lit(None).cast(schemas.STREAM_QUALITY["invalid_by_reason"].dataType).alias("invalid_by_reason"),
        F.col("id").cast("double").alias("avg_lag_seconds"), F.lit(1.0).alias("max_lag_seconds"), F.lit(1.0).alias("processing_seconds"),
        F.timestamp_seconds(F.lit(hour_of(at(0)) * HOUR) + F.col("id") * 300).alias("recorded_at"), F.col("id").alias("batch_id"),
    )
    sinks.append_stream_quality(quality, target.quality_path)
    return target


def hours_in(rows):
    return {f.partition("hour=")[2].partition("/")[0] for f in rows.inputFiles()}


@pytest.mark.parametrize("seconds", [5 * HOUR + 60, 5 * HOUR + 1800, 5 * HOUR])
def test_a_question_of_15_minutes_lists_two_hours_at_most(spark, store, seconds):
    as_of = at(seconds)
    few = store.grid_history(spark, as_of, 15, SETTINGS)
    assert 1 <= len(hours_in(few)) <= 2
    want = views.view_grid_history(store.zone_windows(spark), as_of, 15).collect()
    assert views.view_grid_history(few, as_of, 15).collect() == want and want
    assert {r.total_consumption_kwh for r in want} == {2.0}


@pytest.mark.parametrize("seconds", [5 * HOUR + 60, 5 * HOUR + 1800, 30 * HOUR])
def test_rollups_and_lag_read_recent_hours_only(spark, store, seconds):
    as_of = at(seconds)
    few = store.recent_quality(spark, as_of, SETTINGS)
    assert len(hours_in(few)) <= 2 + SETTINGS.lag_batches // 12
    whole = store.quality(spark).where(F.col("recorded_at") <= F.lit(as_of))
    seen = few.where(F.col("recorded_at") <= F.lit(as_of))
    for ask in (
        lambda q: grid.stream_quality_rollup(q, as_of, SETTINGS),
        lambda q: grid.recent_lag(q, SETTINGS),
    ):
        assert ask(seen).collect() == ask(whole).collect()


def test_expiry_drops_whole_hours_unread(spark, store):
    # Files of expired hours are not opened: one of them is no Parquet file.
    folder = f"{store.zone_windows_path}/hour={hour_of(at(0))}"
    with open(f"{folder}/batch_id=0/broken.parquet", "w") as out:
        out.write("nothing")
    housekeeping.expire_live(spark, store, at(9 * HOUR), SETTINGS)
    limit = hour_of(at(9 * HOUR), SETTINGS.retention_seconds)
    assert min(store.hours(spark, store.zone_windows_path)) == limit
    assert min(store.hours(spark, store.quality_path)) == limit
    assert store.zone_windows(spark).count() == 4 * 6 * (10 - 3)


def test_a_batch_repeated_in_a_later_hour_counts_once(spark, store):
    row = store.quality(spark).where("batch_id = 7").withColumn("total_events", F.lit(5).cast("long"))
    sinks.append_stream_quality(row.withColumn("recorded_at", F.lit(at(20 * HOUR))), store.quality_path)
    assert values(store.quality(spark).where("batch_id = 7"), "total_events") == [(5,)]
    assert values(store.quality_batch(spark, 7), "total_events") == [(5,)]
    assert store.quality(spark).count() == 120


def test_bounds_of_zone_windows(spark, store):
    rows = store.zone_windows(spark, at(2 * HOUR), at(3 * HOUR + 100))
    assert len(hours_in(rows)) == 2 and rows.count() == 4 * 12
    assert store.zone_windows(spark, at(90 * HOUR)).isEmpty()
    assert Store(store.root + "-none").recent_quality(spark, at(0), SETTINGS).isEmpty()
