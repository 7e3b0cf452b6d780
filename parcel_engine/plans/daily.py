"""Ingest, transform and aggregate in sequence, for any set of days at once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from parcel_engine.plans.aggregate import aggregate
from parcel_engine.plans.ingest import ingest, touched_dates
from parcel_engine.plans.transform import transform
from parcel_engine.schemas import KPI
from parcel_engine.sinks.tables import ensure_table, partitions
from parcel_engine.sources.tables import as_date


@dataclass(frozen=True)
class Tables:
    """Names of the four tables of one pipeline."""

    raw: str = "raw_delivery_events"
    facts: str = "delivery_facts"
    kpis: str = "daily_metrics"
    watermarks: str = "pipeline_watermarks"


class RunResult(NamedTuple):
    facts: int
    kpis: int
    dates: set[date]


def run_dates(
    spark: SparkSession,
    tables: Tables,
    dates: Iterable[date | str],
    run_ts: datetime | None = None,
    **options,
) -> RunResult:
    """Transform and aggregate a set of days in one pass; serves daily runs and backfills.

    The days asked for have all of their events in the facts afterwards. Facts of other days
    may change with them: KPIs of such a day are renewed if they were published before, and
    so are complete; a day of which the facts hold only some orders is not published.
    ``options`` go to ``transform``.
    """
    days = {as_date(d) for d in dates}
    if not days:
        return RunResult(0, 0, set())
    done = transform(spark, tables.raw, tables.facts, days, run_ts=run_ts, **options)
    if not spark.catalog.tableExists(tables.facts):
        return RunResult(0, 0, set())
    ensure_table(spark, tables.kpis, KPI)
    affected = days | (done.dates & partitions(spark, tables.kpis))
    kpis = aggregate(spark, tables.facts, tables.kpis, affected, run_ts)
    return RunResult(done.rows, kpis, affected)


def run_daily(
    spark: SparkSession,
    source: DataFrame,
    tables: Tables,
    run_ts: datetime | None = None,
    run_date: str | None = None,
    ingest_options: dict | None = None,
    **options,
) -> RunResult:
    """Ingest what is new, then bring facts and KPIs up to date for the days it touches."""
    added = ingest(
        spark,
        source,
        tables.raw,
        tables.watermarks,
        run_ts=run_ts,
        run_date=run_date,
        **(ingest_options or {}),
    )
    dates = touched_dates(spark, tables.raw, added)
    return run_dates(spark, tables, dates, run_ts=added.run_ts, **options)
