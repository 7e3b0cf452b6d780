"""Command line: ``python -m parcel_engine <job> --date 2024-01-15 --config run.yaml``.

Meant for ``spark-submit``; the session and its catalog come from the cluster. The
database password is read from ``JDBC_PASSWORD`` so that it stays off the command line.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from parcel_engine import watermark
from parcel_engine.plans.aggregate import aggregate
from parcel_engine.plans.daily import run_dates
from parcel_engine.plans.ingest import ingest, touched_dates
from parcel_engine.plans.transform import transform
from parcel_engine.settings import Settings, load_settings
from parcel_engine.sinks.tables import compact_partitions, days_of_small_files, sweep
from parcel_engine.sources.jdbc import jdbc_partitioned_scan
from parcel_engine.sources.tables import as_date

JOBS = ("ingest", "transform", "aggregate", "run", "compact", "sweep")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="parcel_engine")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--date", default=[], action="append", help="YYYY-MM-DD, repeatable; compact takes the days of small files if none is given")
    parser.add_argument("--since", help="read source events after this day, YYYY-MM-DD")
    parser.add_argument("--config", help="settings file")
    parser.add_argument("--scope", choices=("history", "date"), default="history")
    parser.add_argument("--jdbc-url", default=os.environ.get("JDBC_URL"))
    parser.add_argument("--table", help="table to compact or sweep; the facts if not given")
    args = parser.parse_args(argv)
    if not args.date and args.job not in ("ingest", "run", "compact", "sweep"):
        parser.error(f"{args.job} needs --date")
    return args


def _ingest(spark: SparkSession, args: argparse.Namespace, settings: Settings):
    run_ts = datetime.now(timezone.utc)
    tables = settings.tables
    since, found = watermark.current(spark, tables.watermarks, run_ts, settings.lookback)
    start = datetime.fromisoformat(args.since).replace(tzinfo=timezone.utc) if args.since else None
    source = jdbc_partitioned_scan(
        spark,
        args.jdbc_url,
        settings.source_table,
        lower=start or (since - settings.overlap if found else since),
        upper=run_ts,
        num_partitions=settings.num_partitions,
        fetch_size=settings.fetch_size,
        user=os.environ.get("JDBC_USER"),
        password=os.environ.get("JDBC_PASSWORD"),
    )
    return ingest(
        spark,
        source,
        tables.raw,
        tables.watermarks,
        run_ts=run_ts,
        run_date=args.date[-1] if args.date else None,
        lookback=settings.lookback,
        overlap=settings.overlap,
        start=start,
    )


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job; returns the number of rows it wrote, or of folders it removed."""
    settings = load_settings(args.config)
    tables = settings.tables
    rules = dict(
        sla_hours=settings.sla_hours, late_reasons=settings.late_reasons, scope=args.scope
    )
    if args.job in ("ingest", "run") and not args.jdbc_url:
        raise SystemExit("--jdbc-url or JDBC_URL is needed to ingest")
    if args.job == "ingest":
        return _ingest(spark, args, settings).rows
    if args.job == "transform":
        return transform(spark, tables.raw, tables.facts, args.date, **rules).rows
    if args.job == "aggregate":
        return aggregate(spark, tables.facts, tables.kpis, args.date)
    if args.job == "compact":
        table = args.table or tables.facts
        return compact_partitions(spark, table, args.date or days_of_small_files(spark, table))
    if args.job == "sweep":
        return len(sweep(spark, args.table or tables.facts))
    added = _ingest(spark, args, settings)
    dates = touched_dates(spark, tables.raw, added) | {as_date(d) for d in args.date}
    return run_dates(spark, tables, dates, run_ts=added.run_ts, **rules).facts


def main() -> None:
    args = parse()
    spark = SparkSession.builder.appName(f"parcel-{args.job}").getOrCreate()
    try:
        print(f"{args.job}: {run(spark, args)} {'folders' if args.job == 'sweep' else 'rows'}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
