"""Job 1: new source events to the raw table."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine import watermark
from parcel_engine.schemas import RAW, SOURCE, conform
from parcel_engine.session import instant, require_utc
from parcel_engine.sinks.tables import append, ensure_table, partitions
from parcel_engine.sources.tables import enrich_calendar, incremental_scan


class IngestResult(NamedTuple):
    """``since`` is where reading started, ``watermark`` where the next run continues."""

    rows: int
    run_ts: datetime
    since: datetime
    watermark: datetime


def ingest(
    spark: SparkSession,
    source: DataFrame,
    raw_table: str,
    watermark_table: str,
    run_ts: datetime | None = None,
    run_date: str | None = None,
    lookback: timedelta = watermark.LOOKBACK,
    overlap: timedelta = watermark.LOOKBACK,
    job: str = watermark.JOB,
    start: datetime | None = None,
) -> IngestResult:
    """Append the source rows that are new, then advance the watermark.

    Without a watermark, reading starts ``lookback`` before ``run_ts``. With one, it
    starts ``overlap`` before it, so events that reach the source late are still picked
    up; ``overlap`` of zero reads strictly newer rows only. Rows that arrive later than that
    need an explicit ``start``, which replaces both; ``watermark.EVERYTHING`` compares the
    whole source with all of raw, so that no late row is lost. Of what is read, copies that
    the raw table already holds are left out (``EXCEPT ALL``: counted, so equal rows of
    one batch all stay, and added up before the shuffle). A repeated run adds nothing.

    The new watermark is the latest event time added, but not after ``run_ts``: a row
    dated in the future cannot make later runs skip data. It is logged last, and only for
    a non-empty batch, so a run that fails in between is simply repeated.

    The source is scanned once; the row count and the newest time come from the write.
    Where raw holds no day of the range yet, as on a first load, nothing is compared.
    """
    require_utc(spark)
    run_ts = instant(run_ts or datetime.now(timezone.utc))
    mark, found = watermark.current(spark, watermark_table, run_ts, lookback, job)
    since = mark - overlap if found else mark
    if start is not None:
        since = instant(start)
    raw = ensure_table(spark, raw_table, RAW)
    new = conform(incremental_scan(source, since), SOURCE)
    if days_from(spark, raw_table, since):
        known = incremental_scan(raw, since).select(*SOURCE.fieldNames())
        new = new.exceptAll(known)
    newest = F.unix_micros(F.max("event_timestamp")).alias("newest")
    batch = conform(enrich_calendar(new, F.lit(run_ts)), RAW)
    seen = append(batch, raw_table, measures=[newest])
    if not seen["rows"]:
        return IngestResult(0, run_ts, since, mark)
    newest_read = min(watermark.from_micros(seen["newest"]), run_ts)
    mark = max(mark, newest_read) if found else newest_read
    watermark.advance(spark, watermark_table, mark, run_date or str(run_ts.date()), job)
    return IngestResult(seen["rows"], run_ts, since, mark)


def days_from(spark: SparkSession, table: str, since: datetime) -> set[date]:
    """Days of the table that can hold rows after ``since``, from the catalog alone."""
    return {day for day in partitions(spark, table) if day >= since.date()}


def touched_dates(spark: SparkSession, raw_table: str, result: IngestResult) -> set[date]:
    """Every day that rows of the run may lie on.

    This includes the overlap also when the run added nothing there, so the facts of an
    earlier run that stopped after its ingest are made up for.
    """
    return days_from(spark, raw_table, result.since)
