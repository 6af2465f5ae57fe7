"""Keep the micro-batch tables small."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.functions.clock import hour_of, micros_of, seconds_before
from wattledger.plans.snapshots import sweep_snapshots
from wattledger.plans.store import CLOSED_TOTAL, Store
from wattledger.settings import Settings
from wattledger.sinks import tables as sinks
from wattledger.sinks.tables import replace_partitions, sweep_heartbeats
from wattledger.sources import lake as lake_source
from wattledger.sources.files import Folder


def close_day(spark: SparkSession, store: Store, day: int, settings: Settings) -> None:
    """Fold the partial totals of a finished day into one row per household.

    The compact form says up to which micro-batch it reaches and is complete before the folded
    partials go, so a reader counts every batch once at any time. Batches that arrive later add
    to it until the day is closed again.
    """
    folder = Folder(spark, f"{store.partial_totals_path}/sim_day={day}")
    batches = [int(name.partition("=")[2]) for name in folder.names("batch_id=*")]
    if not batches:
        return
    through = max(batches)
    # A batch may land while this runs; it is neither folded nor dropped.
    totals = store.running_totals(spark, settings, [day], through)
    stamped = totals.withColumn("through_batch", F.lit(through).cast("long"))
    staged = f"{store.closed_totals_path}_staged"
    replace_partitions(stamped, staged, ("sim_day",))
    replace_partitions(
        store.read_days(spark, staged, CLOSED_TOTAL, [day]), store.closed_totals_path, ("sim_day",)
    )
    for batch in batches:
        folder.drop(f"batch_id={batch}")


def compact_day(spark: SparkSession, store: Store, day: int) -> int | None:
    """Fold the finished micro-batches of a lake day into one compact form of large files.

    Returns the last micro-batch in the new form, None if there was nothing to fold. A micro-batch
    is finished when a later one has its quality row; a batch that lands meanwhile, or later, stays
    a folder of its own until the day is compacted again. What was folded stays on disk until
    `sweep_lake`.
    """
    newest = store.last_batch(spark)
    folder = Folder(spark, store.lake_path)
    form = lake_source.newest_forms(folder, [day]).get(day)
    folded = -1 if form is None else form.through
    finished = [b for b in lake_source.batches_of(folder, day) if newest is not None and folded < b < newest]
    if not finished:
        return None
    through = max(finished)
    rows = store.lake(spark, [day]).where(F.col("batch_id") <= through)
    sinks.compact_day(rows, store.lake_path, day, through)
    return through


def compact_lake(spark: SparkSession, store: Store, today: int, settings: Settings) -> list[int]:
    """Compact the days before `today`, within the lookback, that have many loose micro-batches."""
    folder = Folder(spark, store.lake_path)
    recent = range(max(0, today - settings.pending_lookback_days), today)
    forms = lake_source.newest_forms(folder, recent) if recent else {}
    done = []
    for day in recent:
        through = forms[day].through if day in forms else -1
        loose = [b for b in lake_source.batches_of(folder, day) if b > through]
        if len(loose) >= settings.compact_batches and compact_day(spark, store, day) is not None:
            done.append(day)
    return done


def sweep_lake(spark: SparkSession, store: Store, as_of, settings: Settings) -> None:
    """Drop what compact forms replaced, a grace period after they were committed.

    That is the micro-batches a form holds, earlier forms of its day, and attempts that were never
    finished and reach no further. A reader that listed them before the commit has the grace
    period to finish.
    """
    folder = Folder(spark, store.lake_path)
    limit = micros_of(as_of) // 1000 - settings.lake_grace_seconds * 1000
    for day, form in lake_source.newest_forms(folder).items():
        committed = folder.last_written(f"{form.name}/_SUCCESS")
        if committed is None or committed > limit:
            continue
        for batch in lake_source.batches_of(folder, day):
            if batch <= form.through:
                folder.drop(f"sim_day={day}/batch_id={batch}")
        for other in lake_source.all_forms(folder, day):
            if other != form and other.through <= form.through:
                folder.drop(other.name)


def _names_of(path: str) -> tuple[int, str]:
    """Day and run of a folder sim_day=D/run_id=R."""
    day, run = path.rstrip("/").rsplit("/", 2)[-2:]
    return int(day.partition("=")[2]), run.partition("=")[2]


def sweep_runs(spark: SparkSession, store: Store, as_of, settings: Settings) -> list[tuple[int, str]]:
    """Drop what superseded and abandoned runs wrote, day by day; returns their days and runs.

    A run is superseded for a day once a later run of that day is committed; its rows stay for the
    grace period after that commit, for readers that looked up the older run before it. A run
    that never committed the day is abandoned when none of its files of the day was written
    within `Settings.abandoned_seconds`; until then it may be at work. A backfill that was
    superseded for one day keeps its others. A run is not to be repeated under the id of one
    that was superseded; jobs draw a new id every time.

    The driver sees folder names and one row per day and run of the reconciliation table.
    """
    log = store.read(spark, store.reconciliation_path, schemas.RECONCILIATION)
    finished = {(r.sim_day, r.run_id) for r in log.select("sim_day", "run_id").distinct().collect()}
    settled = F.col("reconciled_at") <= seconds_before(as_of, settings.grace_seconds)
    newest = {
        r.sim_day: (r.run_id, r.settled)
        for r in store.reconciliation(spark).select("sim_day", "run_id", settled.alias("settled")).collect()
    }
    limit = spark.range(1).select(F.unix_millis(seconds_before(as_of, settings.abandoned_seconds))).first()[0]
    dropped = set()
    for table in (store.daily_path, store.tariff_rows_path, store.tariffs_path, store.bills_path, store.unbilled_path):
        folder = Folder(spark, table)
        for path in folder.paths("sim_day=*/run_id=*"):
            day, run = _names_of(path)
            current, is_settled = newest.get(day, (None, False))
            if run == current:
                continue
            name = f"sim_day={day}/run_id={run}"
            if (day, run) in finished:
                stale = is_settled
            else:
                written = folder.last_written(f"{name}/*")
                stale = written is not None and written < limit
            if stale:
                folder.drop(name)
                dropped.add((day, run))
    return sorted(dropped)


def sweep(spark: SparkSession, store: Store, settings: Settings) -> None:
    """Drop old heartbeat versions, snapshots that no committed chain names, and old rule passes."""
    for path, prefix, kept in ((store.open_alerts_path, "pass=", 3), (store.alerts_path, "pass_id=", settings.kept_passes)):
        folder = Folder(spark, path)
        passes = sorted(folder.names(f"{prefix}*"), key=lambda name: int(name.partition("=")[2]))
        for name in passes[:-kept]:
            folder.drop(name)
    sweep_heartbeats(spark, store.heartbeats_path, settings.grace_seconds)
    sweep_snapshots(spark, store, settings.pending_lookback_days)


def expire_live(spark: SparkSession, store: Store, as_of, settings: Settings) -> None:
    """Drop what the live tables hold from before the retention period.

    Whole hours go without being read. In the hour the limit falls into, micro-batches go in the
    order of their numbers up to the first that still holds a current row. All versions of a key are
    in one hour, so an older version never outlives a newer one.
    """
    limit, edge = seconds_before(as_of, settings.retention_seconds), hour_of(as_of, settings.retention_seconds)
    for path, schema, time in (
        (store.zone_windows_path, schemas.ZONE_WINDOW, "window_start"),
        (store.quality_path, schemas.STREAM_QUALITY, "recorded_at"),
    ):
        folder = Folder(spark, path)
        hours = store.hours(spark, path)
        for hour in hours:
            if hour < edge:
                folder.drop(f"hour={hour}")
        if edge in hours:
            rows = spark.read.schema(schema).option("basePath", path).parquet(folder.child(f"hour={edge}"))
            first = rows.where(F.col(time) >= limit).agg(F.min("batch_id")).first()[0]
            for name in folder.names(f"hour={edge}/batch_id=*"):
                if first is None or int(name.partition("=")[2]) < first:
                    folder.drop(f"hour={edge}/{name}")
