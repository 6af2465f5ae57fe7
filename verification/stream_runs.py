"""Stores filled by real streaming and billing runs over the derived readings.

A run happens once per session and data folder; the queries that look at different tables of
the same store share it.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import inputs
from verification.inputs import SETTINGS, shared
from wattledger.operators.health import latest_heartbeat
from wattledger.operators.readings import decode_readings
from wattledger.plans.billing_run import backfill_days, run_day
from wattledger.plans.housekeeping import compact_lake, sweep_lake
from wattledger.plans.snapshots import take_snapshot
from wattledger.plans.store import Store
from wattledger.session import work_folder
from wattledger.sources.readings import source_readings_stream
from wattledger.sinks import tables as sinks
from wattledger.sources.tariff_files import scan_ready_days
from wattledger.streaming import speed

RUN_AT = datetime(2024, 1, 31, 1, 0, tzinfo=timezone.utc)
LAST_DAY = inputs.DAYS - 1


def at_run() -> datetime:
    return RUN_AT


def messages(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """The reading stream as messages, optionally those of one slice."""
    rows = inputs.reading_events(spark, sf_dir)
    if where is not None:
        rows = rows.where(where)
    fields = [c for c in rows.columns if c not in ("partition", "offset", "batch_id")]
    body = F.to_json(F.struct(*fields)).cast("binary").alias("value")
    return rows.select(body, "partition", "offset")


def decoded_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    source = source_readings_stream(spark, folder, SETTINGS, options=options)
    return decode_readings(source)


def later_copy() -> Column:
    """Repeats that come with a later micro-batch; all else, other repeats too, comes first."""
    return (F.col("offset") % 2 == 1) & (F.col("event_id").cast("long") % 100 == 53)


def late() -> Column:
    return F.col("event_id").cast("long") % 97 == 11


@shared
def message_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = work_folder(spark, "messages")
    messages(spark, sf_dir).write.parquet(folder)
    return folder


def _run_slices(spark: SparkSession, sf_dir: str, slices: list[Column], start) -> Store:
    """Each slice arrives after the previous one was processed and the queries were stopped."""
    store = Store(work_folder(spark, "store"))
    folder = f"{store.root}/incoming"
    for part in slices:
        messages(spark, sf_dir, part).write.mode("append").parquet(folder)
        for query in start(decoded_stream(spark, folder), store):
            query.awaitTermination()
    return store


def _lake(readings: DataFrame, store: Store):
    return speed.start_lake(readings, store, SETTINGS, at_run, available_now=True)


def _windows(readings: DataFrame, store: Store, dedup: bool = False):
    return speed.start_zone_windows(
        readings, store, SETTINGS, at_run, available_now=True, dedup_within_watermark=dedup
    )


@shared
def lake_store(spark: SparkSession, sf_dir: str) -> Store:
    """Lake, quarantine, totals and quality; copies arrive in a second run of the query."""
    return _run_slices(
        spark, sf_dir, [~later_copy(), later_copy()], lambda rows, store: [_lake(rows, store)]
    )


@shared
def compacted_store(spark: SparkSession, sf_dir: str) -> Store:
    """A lake whose finished micro-batches were folded day by day and dropped; copies came later."""
    store = _run_slices(
        spark, sf_dir, [~later_copy(), later_copy()], lambda rows, store: [_lake(rows, store)]
    )
    settings = replace(SETTINGS, compact_batches=1, pending_lookback_days=inputs.DAYS, lake_grace_seconds=0)
    compact_lake(spark, store, inputs.DAYS, settings)
    sweep_lake(spark, store, datetime.now(timezone.utc) + timedelta(seconds=60), settings)
    return store


@shared
def window_store(spark: SparkSession, sf_dir: str) -> Store:
    """Zone windows of the whole stream as one arrival."""
    return _run_slices(
        spark, sf_dir, [F.lit(True)], lambda rows, store: [_windows(rows, store)]
    )


@shared
def updated_window_store(spark: SparkSession, sf_dir: str) -> Store:
    """Zone windows across a restart; windows open at the restart are updated afterwards."""
    early = F.col("timestamp") < "2024-01-16T00:10"
    return _run_slices(
        spark, sf_dir, [early, ~early], lambda rows, store: [_windows(rows, store)]
    )


@shared
def late_store(spark: SparkSession, sf_dir: str) -> Store:
    """Some readings of the whole month arrive after everything else."""
    return _run_slices(
        spark,
        sf_dir,
        [~late(), late()],
        lambda rows, store: [_windows(rows, store), _lake(rows, store)],
    )


@shared
def deduplicated_window_store(spark: SparkSession, sf_dir: str) -> Store:
    return _run_slices(
        spark, sf_dir, [F.lit(True)], lambda rows, store: [_windows(rows, store, True)]
    )


@shared
def copied_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as another stream passes them on."""
    store = Store(work_folder(spark, "store"))
    source = source_readings_stream(spark, message_folder(spark, sf_dir), SETTINGS)
    out = f"{store.root}/copied"
    query = (
        source.writeStream.format("parquet")
        .option("checkpointLocation", store.checkpoint_path("copied"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


@shared
def limited_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per micro-batch when a batch may take at most a third of the message files."""
    folder = message_folder(spark, sf_dir)
    files = len(spark.read.parquet(folder).inputFiles())
    limit = -(-files // 3)
    store = Store(work_folder(spark, "store"))
    out = f"{store.root}/batches"

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("rows"))
        counted.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    query = (
        decoded_stream(spark, folder, maxFilesPerTrigger=str(limit))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", store.checkpoint_path("batches"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(out)
    return rows.agg(
        F.sum("rows").alias("rows"),
        (F.count(F.lit(1)) == -(-files // limit)).alias("limit_kept"),
    )


@shared
def enriched_stream(spark: SparkSession, sf_dir: str, latest: str) -> DataFrame:
    """Clean live readings with the latest tariff, joined while they stream."""
    store = Store(work_folder(spark, "store"))
    graded = speed.grade_readings(
        decoded_stream(spark, message_folder(spark, sf_dir)), SETTINGS
    )
    live = speed.with_sim_day(speed.split_clean(graded), SETTINGS)
    joined = speed.enrich_live_with_tariff(live, spark.read.parquet(latest))
    out = f"{store.root}/enriched"
    query = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", store.checkpoint_path("enriched"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


@shared
def tariff_folder(spark: SparkSession, sf_dir: str) -> str:
    """One CSV folder per day with its marker; the last day is announced but absent."""
    folder = work_folder(spark, "tariffs")
    rows = inputs.tariff_extract(spark, sf_dir, last=LAST_DAY - 1)
    dated = rows.withColumn("day", F.col("sim_day"))
    # A few files per day, not one of every task.
    dated.hint("rebalance", "day").write.option("header", True).partitionBy("day").csv(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for day in range(inputs.DAYS):
        stream = fs.create(hadoop.Path(root, f"_SUCCESS_simday{day}"))
        stream.write(bytearray(f"day={day}\n", "utf-8"))
        stream.close()
    return folder


@shared
def last_tariff_file(spark: SparkSession, sf_dir: str) -> str:
    folder = work_folder(spark, "tariff-last-day")
    # Only that day is made; a filter behind the extract would first make all thirty.
    inputs.tariff_extract(spark, sf_dir, LAST_DAY, LAST_DAY).write.option("header", True).csv(folder)
    return folder


@shared
def billed_store(spark: SparkSession, sf_dir: str) -> Store:
    """All days billed: twenty-nine in one backfill, the last one by two runs of its own."""
    store = lake_store(spark, sf_dir)
    ready = scan_ready_days(spark, tariff_folder(spark, sf_dir))
    days = sorted((row.sim_day, row.path) for row in ready.collect())
    backfill_days(spark, store, days, "backfill", SETTINGS, at_run)
    tariff_file = last_tariff_file(spark, sf_dir)
    for run_id in ("run-a", "run-b"):
        run_day(spark, store, LAST_DAY, tariff_file, run_id, SETTINGS, at_run)
    return store




@shared
def rebilled_store(spark: SparkSession, sf_dir: str) -> Store:
    """The billed days in another order: snapshots of all of them, then one old day billed again."""
    store = Store(work_folder(spark, "store"))
    lake_store(spark, sf_dir).lake(spark).write.partitionBy("sim_day", "batch_id").parquet(store.lake_path)
    ready = scan_ready_days(spark, tariff_folder(spark, sf_dir))
    days = sorted((row.sim_day, row.path) for row in ready.collect())
    backfill_days(spark, store, days[:20], "first", SETTINGS, at_run)
    backfill_days(spark, store, days[20:], "second", SETTINGS, at_run)
    run_day(spark, store, LAST_DAY, last_tariff_file(spark, sf_dir), "last", SETTINGS, at_run)
    old, path = days[7]
    run_day(spark, store, old, path, "again", SETTINGS, at_run)
    take_snapshot(spark, store)
    return store


@shared
def heartbeat_store(spark: SparkSession, sf_dir: str) -> Store:
    """The heartbeats known after a week, three weeks and at last, each written by the sink."""
    store = Store(work_folder(spark, "store"))
    beats = inputs.heartbeats(spark, sf_dir)
    for until in ("2024-01-08", "2024-01-22", "2100-01-01"):
        known = latest_heartbeat(beats.where(F.col("last_heartbeat") < F.lit(until).cast("timestamp")))
        sinks.upsert_heartbeat(known, store.heartbeats_path)
    return store


@shared
def priced_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean live readings with the latest tariffs of the billed store."""
    store = billed_store(spark, sf_dir)
    readings = decoded_stream(spark, message_folder(spark, sf_dir))
    speed.start_priced_live(readings, store, SETTINGS, at_run, available_now=True).awaitTermination()
    return spark.read.parquet(store.priced_live_path)
