"""Reading events and facts: newer than a watermark, or of certain days."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.session import instant

NO_OVERLAP = timedelta(0)


def as_date(value: date | str) -> date:
    """A date from a date or an ISO string; anything malformed raises ValueError."""
    if isinstance(value, datetime):
        raise ValueError(f"expected a date, not a timestamp: {value}")
    return value if isinstance(value, date) else date.fromisoformat(value)


def date_slice(df: DataFrame, dates: Iterable[date | str] | date | str) -> DataFrame:
    """Rows of one or more days. On tables partitioned by day, only those are read."""
    if isinstance(dates, (date, str)):
        dates = [dates]
    return df.filter(F.col("event_date").isin([as_date(d) for d in dates]))


def incremental_scan(
    events: DataFrame, watermark: datetime, overlap: timedelta = NO_OVERLAP
) -> DataFrame:
    """Rows strictly newer than the watermark less ``overlap``.

    The literal takes the column's own type, so the comparison reaches the source
    (Parquet row groups or the database). On a table with ``event_date`` the same bound
    prunes partitions.
    """
    since = F.lit(instant(watermark) - overlap)
    at = F.col("event_timestamp")
    newer = at > since.cast(events.schema["event_timestamp"].dataType)
    if "event_date" in events.columns:
        newer = newer & (F.col("event_date") >= F.to_date(since))
    return events.filter(newer)


def enrich_calendar(events: DataFrame, ingested_at) -> DataFrame:
    """Source rows plus ``_ingested_at``, ``event_date``, ``year``, ``month`` and ``day``."""
    at = F.col("event_timestamp")
    return events.withColumns(
        {
            "_ingested_at": ingested_at,
            "event_date": F.to_date(at),
            "year": F.year(at),
            "month": F.month(at),
            "day": F.dayofmonth(at),
        }
    )
