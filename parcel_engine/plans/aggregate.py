"""Job 3: curated facts to daily courier KPIs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import SparkSession

from parcel_engine.operators.kpis import courier_daily_kpis
from parcel_engine.schemas import KPI, conform
from parcel_engine.session import require_utc
from parcel_engine.sinks.tables import ensure_table, overwrite_partitions, partitions
from parcel_engine.sources.tables import as_date, date_slice


def aggregate(
    spark: SparkSession,
    facts_table: str,
    kpi_table: str,
    dates: Iterable[date | str] | None = None,
    run_ts: datetime | None = None,
    approximate_p95: bool = False,
) -> int:
    """Replace the KPI partitions of the given days, or of all; returns the rows written.

    A day that has no facts any more loses its KPI partition.
    """
    require_utc(spark)
    ensure_table(spark, kpi_table, KPI)
    present = partitions(spark, facts_table)
    asked = present | partitions(spark, kpi_table)
    if dates is not None:
        asked = {as_date(d) for d in dates}
    facts = date_slice(spark.table(facts_table), sorted(asked & present))
    daily = conform(courier_daily_kpis(facts, run_ts, approximate_p95), KPI)
    return overwrite_partitions(daily, kpi_table, emptied=asked - present)
