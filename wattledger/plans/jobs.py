"""Command line of the jobs, for spark-submit.

spark-submit wattledger/plans/jobs.py speed --store ROOT --topic T --source-option k=v
spark-submit wattledger/plans/jobs.py bill-day --store ROOT --sim-day 3 --tariff-file F
spark-submit wattledger/plans/jobs.py backfill --store ROOT --tariff-folder DIR
spark-submit wattledger/plans/jobs.py alerts --store ROOT --pass-id 7
spark-submit wattledger/plans/jobs.py sample-gauges --store ROOT
spark-submit wattledger/plans/jobs.py report --store ROOT --sim-day 3 --out DIR
spark-submit wattledger/plans/jobs.py close-day --store ROOT --sim-day 3
spark-submit wattledger/plans/jobs.py compact-day --store ROOT --sim-day 3
spark-submit wattledger/plans/jobs.py compact --store ROOT
spark-submit wattledger/plans/jobs.py expire --store ROOT
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from wattledger.operators.readings import decode_readings
from wattledger.operators.reconciliation import pending_days
from wattledger.plans.alert_pass import run_alert_pass, sample_gauges
from wattledger.plans.billing_run import backfill_days, run_day
from wattledger.plans.housekeeping import (
    close_day,
    compact_day,
    compact_lake,
    expire_live,
    sweep,
    sweep_lake,
    sweep_runs,
)
from wattledger.plans.report import write_report
from wattledger.plans.store import Store
from wattledger.session import prepare
from wattledger.settings import Settings
from wattledger.sources.readings import source_readings_stream
from wattledger.sources.tariff_files import scan_ready_days
from wattledger.streaming.speed import start_lake, start_priced_live, start_zone_windows, utc_now


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    billing = ("bill-day", "backfill", "report")
    keeping = ("close-day", "compact-day", "compact", "expire")
    for name in ("speed", *billing, "alerts", "sample-gauges", *keeping):
        job = jobs.add_parser(name)
        job.add_argument("--store", required=True)
        job.add_argument("--set", action="append", default=[], metavar="SETTING=VALUE")
        if name == "speed":
            job.add_argument("--topic", required=True)
            job.add_argument("--format", default="kafka")
            job.add_argument("--source-option", action="append", default=[])
            job.add_argument("--dedup-within-watermark", action="store_true")
            job.add_argument("--available-now", action="store_true")
        if name in ("bill-day", "report", "close-day", "compact-day"):
            job.add_argument("--sim-day", type=int, required=True)
        if name == "bill-day":
            job.add_argument("--tariff-file", required=True)
        if name == "backfill":
            job.add_argument("--tariff-folder", required=True)
        if name == "alerts":
            job.add_argument("--pass-id", type=int, required=True)
        if name == "report":
            job.add_argument("--out", required=True)
    return parser


def _speed(spark: SparkSession, store: Store, settings: Settings, args) -> None:
    options = _pairs(args.source_option)
    readings = decode_readings(
        source_readings_stream(spark, args.topic, settings, args.format, options)
    )
    queries = [
        start_zone_windows(
            readings,
            store,
            settings,
            available_now=args.available_now,
            dedup_within_watermark=args.dedup_within_watermark,
        ),
        start_lake(readings, store, settings, available_now=args.available_now),
        start_priced_live(readings, store, settings, available_now=args.available_now),
    ]
    if args.available_now:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def _today(settings: Settings) -> int:
    """Number of the running day."""
    return int((utc_now().timestamp() - settings.epoch_seconds) // settings.day_seconds)


def _backfill(spark: SparkSession, store: Store, settings: Settings, folder: str) -> None:
    """Bill every pending day whose tariff file is ready."""
    today = _today(settings)
    recent = range(max(0, today - settings.pending_lookback_days), today)
    lake_days = store.lake(spark, recent).select("sim_day").distinct()
    # A day whose tariff file was all invalid has a reconciliation but no bills: it stays pending.
    billed = store.bills(spark, recent).select("sim_day").distinct()
    pending = {r.sim_day for r in pending_days(spark, lake_days, billed, today, settings).collect()}
    ready = scan_ready_days(spark, folder, pending)
    chosen = sorted((row.sim_day, row.path) for row in ready.collect())
    if chosen:
        backfill_days(spark, store, chosen, uuid.uuid4().hex[:12], settings)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    settings = Settings.from_mapping(_pairs(args.set))
    spark = prepare(spark or SparkSession.builder.appName(f"metering-{args.job}").getOrCreate())
    store = Store(args.store)
    if args.job == "speed":
        _speed(spark, store, settings, args)
    elif args.job == "bill-day":
        run_id = uuid.uuid4().hex[:12]
        run_day(spark, store, args.sim_day, args.tariff_file, run_id, settings)
    elif args.job == "backfill":
        _backfill(spark, store, settings, args.tariff_folder)
    elif args.job == "alerts":
        run_alert_pass(spark, store, utc_now(), args.pass_id, settings)
    elif args.job == "sample-gauges":
        sample_gauges(spark, store, utc_now(), settings)
    elif args.job == "close-day":
        close_day(spark, store, args.sim_day, settings)
    elif args.job == "compact-day":
        compact_day(spark, store, args.sim_day)
    elif args.job == "compact":
        compact_lake(spark, store, _today(settings), settings)
    elif args.job == "expire":
        expire_live(spark, store, utc_now(), settings)
        sweep(spark, store, settings)
        sweep_runs(spark, store, utc_now(), settings)
        sweep_lake(spark, store, utc_now(), settings)
    else:
        write_report(store.bills(spark, [args.sim_day]), args.sim_day, args.out)


if __name__ == "__main__":
    main()
