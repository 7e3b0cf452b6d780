"""Finding what raw lacks of its source, or has beyond it, without comparing everything.

Both sides are reduced to checksums that do not depend on the order of rows: how many there are,
and the sum of their 64-bit hashes. A first level has one per day, a second one per day and hash
bucket, computed of the days that differ alone. Only rows of buckets that differ are compared
themselves. Late rows of any age are found like this, also those older than the overlap.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.schemas import RAW, SOURCE, conform
from parcel_engine.session import instant, require_utc, staging
from parcel_engine.sinks.tables import append, ensure_table
from parcel_engine.sources.tables import date_slice, enrich_calendar

BUCKETS = 64


class Reconciled(NamedTuple):
    """``compared``: rows of the source that were read one by one."""

    days: set[date]
    buckets: int
    compared: int
    missing: int
    surplus: int


def row_hash() -> Column:
    """A 64-bit hash of the nine source columns that tells a null from its neighbours."""
    columns = [F.col(name) for name in SOURCE.fieldNames()]
    empty = [F.col(f.name).isNull() for f in SOURCE if f.nullable]
    return F.xxhash64(*columns, *empty)


def checksums(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and sum of hashes per key; fixed width, combined before the shuffle."""
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("sum")
    )


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose checksums differ, or that only one side has."""
    a = checksums(left, keys).select(*keys, F.struct("n", "sum").alias("_a"))
    b = checksums(right, keys).select(*keys, F.struct("n", "sum").alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys)


def of_days(events: DataFrame, days: set[date]) -> DataFrame:
    """Events of some days, by a range of their time that a source can apply, and exactly."""
    low = datetime.combine(min(days), datetime.min.time(), timezone.utc)
    high = datetime.combine(max(days), datetime.min.time(), timezone.utc) + timedelta(days=1)
    at = F.col("event_timestamp")
    kind = events.schema["event_timestamp"].dataType
    near = events.filter((at >= F.lit(low).cast(kind)) & (at < F.lit(high).cast(kind)))
    return near.filter(F.to_date(at).isin(sorted(days)))


def _marked(events: DataFrame, buckets: int) -> DataFrame:
    """The source columns with day, bucket and hash."""
    rows = conform(events, SOURCE).withColumn("_hash", row_hash())
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")
    return rows.withColumn("_day", F.to_date("event_timestamp")).withColumn("_bucket", bucket)


def reconcile(
    spark: SparkSession,
    source: DataFrame,
    raw_table: str,
    run_ts: datetime | None = None,
    buckets: int = BUCKETS,
) -> Reconciled:
    """Append what raw lacks; rows that raw has beyond the source are counted and stay.

    Raw lies by the day of the event time, as ``ingest`` writes it. Equal rows count: the source
    must not have more of them than raw. Days are collected, and how many rows differ.
    """
    require_utc(spark)
    run_ts = instant(run_ts or datetime.now(timezone.utc))
    raw = ensure_table(spark, raw_table, RAW)
    days = {r[0] for r in differing(_marked(source, buckets), _marked(raw, buckets), ["_day"]).collect()}
    days.discard(None)
    if not days:
        return Reconciled(set(), 0, 0, 0, 0)
    theirs = _marked(of_days(source, days), buckets)
    ours = _marked(date_slice(raw, sorted(days)), buckets)
    place = ["_day", "_bucket"]
    with staging(spark) as stage:
        parts = stage.keep(differing(theirs, ours, place))
        columns = SOURCE.fieldNames()
        theirs = stage.keep(theirs.join(parts, place, "left_semi").select(*columns))
        ours = stage.keep(ours.join(parts, place, "left_semi").select(*columns))
        surplus = ours.exceptAll(theirs).count()
        batch = conform(enrich_calendar(theirs.exceptAll(ours), F.lit(run_ts)), RAW)
        missing = append(batch, raw_table)["rows"]
        return Reconciled(days, parts.count(), theirs.count(), missing, surplus)
