"""High-water mark of the ingest: a small append-only log, one row per successful run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.schemas import WATERMARK
from parcel_engine.session import instant
from parcel_engine.sinks.tables import append, ensure_table

JOB = "ingest_delivery_events"
LOOKBACK = timedelta(days=3)
#: A start before all events.
EVERYTHING = datetime(1900, 1, 1, tzinfo=timezone.utc)


def latest_watermark(log: DataFrame, job: str = JOB) -> DataFrame:
    """One row with the newest watermark of ``job``; null if it has none."""
    return log.filter(F.col("job") == job).agg(F.max("watermark_ts").alias("watermark_ts"))


def fallback(run_ts: datetime, lookback: timedelta = LOOKBACK) -> datetime:
    """Where a job without a watermark starts."""
    return instant(run_ts) - lookback


def current(
    spark: SparkSession,
    table: str,
    run_ts: datetime,
    lookback: timedelta = LOOKBACK,
    job: str = JOB,
) -> tuple[datetime, bool]:
    """The watermark to read from, and whether the log held one.

    Only a missing table or a log without rows for the job leads to the fallback. Any
    other failure to read the log is raised, since guessing would skip or repeat data.
    """
    if spark.catalog.tableExists(table):
        micros = F.unix_micros("watermark_ts").alias("micros")
        row = latest_watermark(spark.table(table), job).select(micros).first()
        if row.micros is not None:
            return from_micros(row.micros), True
    return fallback(run_ts, lookback), False


def from_micros(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def advance(
    spark: SparkSession, table: str, watermark: datetime, run_date: str, job: str = JOB
) -> None:
    """Append one row to the log, creating the log first if needed."""
    ensure_table(spark, table, WATERMARK, partition_by=None)
    append(spark.createDataFrame([(job, instant(watermark), run_date)], WATERMARK), table)
