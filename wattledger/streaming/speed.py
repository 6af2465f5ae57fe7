"""The two streaming queries: zone windows, and lake with running totals and quality.

State of the window query lives in as many partitions as `spark.sql.shuffle.partitions` had when
its checkpoint was created; set it for the expected event rate before the first start.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattledger.functions.clock import instant
from wattledger.operators.consumption import (
    household_microbatch_totals,
    microbatch_quality,
    zone_window_metrics,
)
from wattledger.operators.readings import (
    dedup_microbatch,
    grade_readings,
    split_clean,
    split_invalid,
    with_sim_day,
)
from wattledger.plans import snapshots
from wattledger.plans.store import Store
from wattledger.settings import Settings
from wattledger.sinks import tables as sinks
from wattledger.sources.files import Folder

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


#: Micro-batches that one checkpoint may count before its numbers reach those of the next.
GENERATION_BATCHES = 1 << 40


def batch_offset(spark: SparkSession, store: Store, query: str) -> int:
    """What is added to the batch numbers of a query's present checkpoint.

    A new checkpoint counts from 0 again. Its generation, kept inside the checkpoint and in a list
    beside the tables, puts its batches after all earlier ones, so that no partition of another
    checkpoint is replaced and the newest version of a key has the highest number. A checkpoint
    from before the list has generation 0.
    """
    folder = Folder(spark, store.root)
    own, listed = f"_checkpoints/{query}/generation=", f"_generations/{query}="
    marks = [int(n.partition("=")[2]) for n in folder.names(f"{own}*")]
    if marks:
        return max(marks) * GENERATION_BATCHES
    known = [int(n.partition("=")[2]) for n in folder.names(f"{listed}*")]
    running = folder.exists(f"_checkpoints/{query}/offsets")
    generation = max(known, default=0 if running else int(store.holds_batches(spark)) - 1) + (not running)
    folder.mark(f"{listed}{generation}")
    folder.mark(f"{own}{generation}")
    return generation * GENERATION_BATCHES


def _started(writer, checkpoint: str, settings: Settings, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=settings.trigger).start()


def stream_zone_windows(
    readings: DataFrame, settings: Settings, dedup_within_watermark: bool = False
) -> DataFrame:
    """Sliding zone windows of a decoded stream; readings behind the watermark are dropped.

    `dedup_within_watermark` also removes repeated deliveries across micro-batches. It is off by
    default: the live view then counts them, which is what reconciliation measures.
    """
    clean = split_clean(grade_readings(readings, settings))
    timed = clean.withWatermark("event_time", settings.watermark)
    if dedup_within_watermark:
        timed = timed.dropDuplicatesWithinWatermark(["event_id"])
    return zone_window_metrics(timed, settings)


def start_zone_windows(
    readings: DataFrame,
    store: Store,
    settings: Settings,
    now: Clock = utc_now,
    available_now: bool = False,
    dedup_within_watermark: bool = False,
) -> StreamingQuery:
    """Keep the zone windows of the store current; every micro-batch writes what it changed."""

    offset = batch_offset(readings.sparkSession, store, "zone_windows")

    def write(windows: DataFrame, batch_id: int) -> None:
        number = offset + batch_id
        sinks.upsert_zone_windows(windows, store.zone_windows_path, number, instant(now()))

    windows = stream_zone_windows(readings, settings, dedup_within_watermark)
    writer = windows.writeStream.outputMode("update").foreachBatch(write)
    checkpoint = store.checkpoint_path("zone_windows")
    return _started(writer.queryName("zone_windows"), checkpoint, settings, available_now)


def write_lake_batch(
    readings: DataFrame, batch_id: int, store: Store, settings: Settings, now: Clock = utc_now
) -> None:
    """All outputs of one micro-batch.

    Quarantine, lake, partial totals and the quality row are each keyed by the batch, so a batch
    repeated after a failure replaces what it wrote before. Graded and de-duplicated rows are
    cached because four writes use them; lost cache blocks are recomputed from the source. The
    cache is on disk: a batch that catches up holds whole files of messages in few blocks, and two
    copies of them do not fit beside the tasks.
    """
    started = now()
    batch = readings.withColumn("batch_id", F.lit(batch_id).cast("long"))
    graded = grade_readings(batch, settings).persist(StorageLevel.DISK_ONLY)
    kept = dedup_microbatch(split_clean(graded)).persist(StorageLevel.DISK_ONLY)
    try:
        clean = with_sim_day(kept, settings)
        sinks.sink_quarantine(split_invalid(graded), store.quarantine_path, instant(started))
        sinks.sink_lake(clean, store.lake_path)
        sinks.upsert_running_totals(
            household_microbatch_totals(clean, settings), store.partial_totals_path
        )
        timed = kept.withColumn("processed_at", instant(started))
        finished = now()
        quality = microbatch_quality(graded, timed, settings).withColumns(
            {
                "processing_seconds": F.lit(round((finished - started).total_seconds(), 3)),
                "recorded_at": instant(finished),
            }
        )
        sinks.append_stream_quality(quality, store.quality_path)
        written = store.quality_batch(batch.sparkSession, batch_id)
        detail = F.format_string(
            "batch_id=%d clean=%d invalid=%d dup=%d",
            "batch_id",
            "clean_events",
            "invalid_events",
            "duplicate_events",
        )
        beat = written.select(
            F.lit("speed_layer").alias("component"),
            F.col("recorded_at").alias("last_heartbeat"),
            F.lit("OK").alias("status"),
            detail.alias("detail"),
        )
        sinks.upsert_heartbeat(beat, store.heartbeats_path)
    finally:
        kept.unpersist()
        graded.unpersist()


def start_lake(
    readings: DataFrame,
    store: Store,
    settings: Settings,
    now: Clock = utc_now,
    available_now: bool = False,
) -> StreamingQuery:
    """Store every reading, late ones included: lake, quarantine, running totals and quality."""

    offset = batch_offset(readings.sparkSession, store, "raw_lake")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_lake_batch(batch, offset + batch_id, store, settings, now)

    writer = readings.writeStream.foreachBatch(write).queryName("raw_lake")
    return _started(writer, store.checkpoint_path("raw_lake"), settings, available_now)


def start_priced_live(
    readings: DataFrame,
    store: Store,
    settings: Settings,
    now: Clock = utc_now,
    available_now: bool = False,
) -> StreamingQuery:
    """Clean live readings with their household's latest tariff, into the priced feed.

    The tariffs are looked up anew in every micro-batch, in the newest snapshot, so a day that is
    billed while the query runs shows in the next one.
    """
    spark = readings.sparkSession
    offset = batch_offset(spark, store, "priced_live")

    def write(batch: DataFrame, batch_id: int) -> None:
        live = with_sim_day(split_clean(grade_readings(batch, settings)), settings)
        latest = snapshots.latest_tariffs(snapshots.household_state(spark, store))
        priced = enrich_live_with_tariff(live, latest).withColumn("priced_at", instant(now()))
        sinks.append_priced_live(priced, store.priced_live_path, offset + batch_id)

    writer = readings.writeStream.foreachBatch(write).queryName("priced_live")
    return _started(writer, store.checkpoint_path("priced_live"), settings, available_now)


def enrich_live_with_tariff(live: DataFrame, latest_tariffs: DataFrame) -> DataFrame:
    """Live rows with the household's latest tariff; `live` may be a stream."""
    return live.join(latest_tariffs, "household_id", "left")
