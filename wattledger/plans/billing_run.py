"""Billing runs: one day against its tariff file, or many days in one job.

Each stage is written to its table and read back, so a lost executor costs one stage at most and
no stage is computed twice. The reconciliation row is written last and makes the run visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger import schemas
from wattledger.functions.clock import instant
from wattledger.operators import bills as bill_ops
from wattledger.operators import reconciliation, tariffs
from wattledger.operators.consumption import household_daily
from wattledger.operators.readings import first_measures
from wattledger.plans import snapshots
from wattledger.plans.store import TARIFF_ROW, Store
from wattledger.settings import Settings
from wattledger.sinks import tables as sinks
from wattledger.sources import tariff_files
from wattledger.sources.lake import scan_lake_day
from wattledger.streaming.speed import Clock, utc_now


def exact_daily(readings: DataFrame, settings: Settings) -> DataFrame:
    """Exact totals from lake rows that may hold repeated deliveries."""
    return household_daily(first_measures(readings, settings), settings)


class _Run:
    """The stages a run shares, whether it bills one day or many."""

    def __init__(self, spark, store: Store, settings: Settings, run_id: str, days: Sequence[int]):
        self.spark = spark
        self.store = store
        self.settings = settings
        self.run_id = run_id
        self.days = list(days)

    def _stage(self, rows: DataFrame, path: str, schema, balance: bool = True) -> DataFrame:
        sinks.replace_day(rows, path, self.run_id, balance)
        written = self.store.read_days(self.spark, path, schema, self.days)
        return written.where(F.col("run_id") == self.run_id).drop("run_id")

    def daily(self, lake: DataFrame) -> DataFrame:
        rows = exact_daily(lake, self.settings)
        return self._stage(rows, self.store.daily_path, schemas.HOUSEHOLD_DAILY)

    def tariff_rows(self, extract: DataFrame) -> DataFrame:
        rows = tariffs.validate_tariff(extract, self.settings)
        # A tariff file is of one day, so its splits are written as they are read, without a shuffle.
        return self._stage(rows, self.store.tariff_rows_path, TARIFF_ROW, balance=False)

    def reference(self, validated: DataFrame) -> DataFrame:
        rows = tariffs.dedup_tariff(validated)
        return self._stage(rows, self.store.tariffs_path, schemas.TARIFF_REFERENCE)

    def _priced(self, enriched: DataFrame) -> DataFrame:
        """Bills, and the household-days without one. Tariffs are looked up once for both."""
        enriched = enriched.persist()
        try:
            sinks.replace_day(
                bill_ops.unbilled_households(enriched), self.store.unbilled_path, self.run_id
            )
            bills = bill_ops.compute_bills(enriched, self.settings)
            return self._stage(bills, self.store.bills_path, schemas.BILL)
        finally:
            enriched.unpersist()

    def finish(self, enriched, lake, daily, validated, reference, now: Clock) -> None:
        billed = self._priced(enriched)
        metrics = reconciliation.reconciliation_metrics(
            self.store.running_totals(self.spark, self.settings, self.days),
            daily,
            lake,
            validated,
            reference,
            billed,
            self.settings,
        )
        finished = instant(now())
        sinks.upsert_reconciliation(
            metrics, self.store.reconciliation_path, self.run_id, finished
        )


def _beat(spark, store: Store, detail, status: str, now: Clock) -> None:
    row = spark.range(1).select(
        F.lit("batch_layer").alias("component"),
        instant(now()).alias("last_heartbeat"),
        F.lit(status).alias("status"),
        F.lit(detail[:500]).alias("detail"),
    )
    sinks.upsert_heartbeat(row, store.heartbeats_path)


def _log(spark, store: Store, task: str, days: Sequence[int], error: str | None, now: Clock) -> None:
    """The outcome of a step for each of its days; `rule_task_failed` reads it."""
    state, text = ("success", None) if error is None else ("failed", error[:500])
    rows = spark.range(1).select(
        F.lit("billing").alias("dag_id"),
        F.lit(task).alias("task_id"),
        F.explode(F.array(*map(F.lit, days))).alias("sim_day"),
        F.lit(state).alias("state"),
        F.lit(text).cast("string").alias("error"),
        instant(now()).alias("finished_at"),
    )
    sinks.append_run_log(rows, store.run_log_path)


def run_day(
    spark: SparkSession,
    store: Store,
    day: int,
    tariff_file: str,
    run_id: str,
    settings: Settings,
    now: Clock = utc_now,
) -> None:
    """Bill one finished day; running it again replaces the day. An empty day is an error."""
    run = _Run(spark, store, settings, run_id, [day])
    try:
        lake = scan_lake_day(spark, store.lake_path, day)
        daily = run.daily(lake)
        extract = tariffs.stamp_day(tariff_files.scan_tariff_csv(spark, tariff_file), day)
        validated = run.tariff_rows(extract)
        reference = run.reference(validated)
        previous = snapshots.previous_tariffs(snapshots.take_snapshot(spark, store, day - 1))
        joined = tariffs.join_tariff_previous(
            tariffs.join_tariff_today(daily, reference), previous
        )
        enriched = tariffs.with_effective_tariff(joined)
        run.finish(enriched, lake, daily, validated, reference, now)
        snapshots.take_snapshot(spark, store)
    except Exception as error:
        _log(spark, store, "bill_day", [day], str(error), now)
        _beat(spark, store, f"FAILED sim_day={day}: {error}", "FAILED", now)
        raise
    _log(spark, store, "bill_day", [day], None, now)
    _beat(spark, store, f"sim_day={day} run_id={run_id}", "OK", now)


def backfill_days(
    spark: SparkSession,
    store: Store,
    ready: Sequence[tuple[int, str]],
    run_id: str,
    settings: Settings,
    now: Clock = utc_now,
) -> None:
    """Bill many days in one job: `ready` lists each day with its tariff file.

    Days without readings are skipped. Tariffs of earlier committed runs serve as fallback, as
    they would if the days had been billed one after the other.
    """
    days = [day for day, _ in ready]
    run = _Run(spark, store, settings, run_id, days)
    try:
        lake = store.lake(spark, days)
        daily = run.daily(lake)
        # A day without readings is not run, so its tariffs are not stored and never a fallback.
        present = F.broadcast(daily.select("sim_day").distinct())
        extract = tariff_files.scan_tariff_files(spark, list(ready))
        billed = extract.join(present.select(F.col("sim_day").cast("string")), "sim_day", "left_semi")
        validated = run.tariff_rows(billed.select(extract.columns))
        reference = run.reference(validated)
        known = reference.unionByName(_fallback_tariffs(spark, store, days))
        enriched = tariffs.asof_tariff(daily, known)
        run.finish(enriched, lake, daily, validated, reference, now)
        snapshots.take_snapshot(spark, store)
    except Exception as error:
        _log(spark, store, "backfill_days", days, str(error), now)
        _beat(spark, store, f"FAILED days={days}: {error}", "FAILED", now)
        raise
    _log(spark, store, "backfill_days", days, None, now)
    _beat(spark, store, f"days={days} run_id={run_id}", "OK", now)


def _fallback_tariffs(spark: SparkSession, store: Store, days: Sequence[int]) -> DataFrame:
    """Stored tariffs a run over `days` can fall back to.

    Of the days before the first billed one only the newest tariff per household can matter, and
    the snapshot of the day before has it.
    """
    first, last = min(days), max(days)
    between = store.tariffs(spark, [d for d in range(first + 1, last) if d not in set(days)])
    before = snapshots.latest_tariffs(snapshots.take_snapshot(spark, store, first - 1))
    stacked = before.withColumnRenamed("tariff_sim_day", "sim_day")
    return between.select(*stacked.columns).unionByName(stacked)
