"""KPIs kept up to date by signed changes of the facts.

The histogram of durations, from which all KPIs follow, is a table. An upsert adds to it, for each
courier, day and duration, what its rows are more or fewer: the changed facts' old images count
minus one, the new ones plus one, added up first. The histogram in force is the sum of all that,
and rows that cancel out are gone. KPIs of any days are read from it; the facts are not.

A run that stops between histogram and facts would leave them apart. So the days of an upsert are
noted on the table before it changes and cleared when the facts have followed; days still noted
when the next run starts are counted anew from the facts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from parcel_engine.operators.kpis import DAY, HISTOGRAM_COUNTS, duration_histogram, kpis_of
from parcel_engine.schemas import DATE, DOUBLE, LONG, STRING
from parcel_engine.sinks.tables import (
    append,
    ensure_table,
    partitions,
    properties,
    replace_days,
)
from parcel_engine.sinks.upsert import UpsertResult, upsert
from parcel_engine.sources.tables import as_date, date_slice

HISTOGRAM = StructType(
    [
        StructField("courier_id", STRING),
        StructField("event_date", DATE),
        StructField("delivery_duration_hours", DOUBLE),
        *[StructField(name, LONG) for name in HISTOGRAM_COUNTS],
    ]
)
#: Property of the histogram: days that an unfinished upsert may have changed.
UNSETTLED = "parcel.unsettled_days"
#: What the histogram needs of a fact.
IMAGE = (*DAY, "event_type", "delivery_duration_hours", "is_failed", "is_on_time")


def signed_histogram(before: DataFrame, after: DataFrame) -> DataFrame:
    """What ``after`` has more than ``before``, per courier, day and duration; no rows of zeros."""
    minus = duration_histogram(before).select(
        *DAY, "delivery_duration_hours", *[(-F.col(c)).alias(c) for c in HISTOGRAM_COUNTS]
    )
    return summed(duration_histogram(after).unionByName(minus))


def summed(histogram: DataFrame) -> DataFrame:
    """The histogram in force: rows added up, those that cancel out left away."""
    total = histogram.groupBy(*DAY, "delivery_duration_hours").agg(
        *[F.sum(c).alias(c) for c in HISTOGRAM_COUNTS]
    )
    changed = F.lit(False)
    for c in HISTOGRAM_COUNTS:
        changed = changed | (F.col(c) != 0)
    return total.filter(changed)


def unsettled(spark: SparkSession, histogram_table: str) -> set[date]:
    value = properties(spark, histogram_table).get(UNSETTLED, "")
    return {as_date(d) for d in value.split(",") if d}


def _note(spark: SparkSession, histogram_table: str, days: Iterable[date]) -> None:
    value = ",".join(str(d) for d in sorted(days))
    spark.sql(f"ALTER TABLE {histogram_table} SET TBLPROPERTIES ('{UNSETTLED}' = '{value}')")


def recount(
    spark: SparkSession, facts_table: str, histogram_table: str, dates: Iterable[date]
) -> None:
    """Count days anew from the facts."""
    days = set(dates)
    if not days:
        return
    present = days & partitions(spark, facts_table)
    counted = duration_histogram(date_slice(spark.table(facts_table), sorted(present)))
    replace_days(counted, histogram_table, emptied=days - present)


def upsert_counted(
    source: DataFrame,
    facts_table: str,
    histogram_table: str,
    keys: Sequence[str] = ("event_id",),
    **options,
) -> UpsertResult:
    """``upsert`` into the facts, with the histogram kept in step. ``options`` go to ``upsert``.

    Of the facts, the rows that are replaced are read, in the columns the histogram needs. A
    histogram that does not exist is counted once from the facts there are.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(histogram_table):
        ensure_table(spark, histogram_table, HISTOGRAM)
        if spark.catalog.tableExists(facts_table):
            _note(spark, histogram_table, partitions(spark, facts_table))
    recount(spark, facts_table, histogram_table, unsettled(spark, histogram_table))
    _note(spark, histogram_table, [])

    def record(before: DataFrame, after: DataFrame, days: set[date]) -> None:
        _note(spark, histogram_table, days)
        append(signed_histogram(before.select(*IMAGE), after.select(*IMAGE)), histogram_table)

    done = upsert(source, facts_table, keys, on_change=record, **options)
    _note(spark, histogram_table, [])
    return done


def fold(spark: SparkSession, histogram_table: str, dates: Iterable[date | str]) -> int:
    """Replace the changes of some days by their sum; the KPIs stay the same."""
    days = {as_date(d) for d in dates} & partitions(spark, histogram_table)
    if not days:
        return 0
    now = summed(date_slice(spark.table(histogram_table), sorted(days)))
    kept = {r[0] for r in now.select("event_date").distinct().collect()}
    return replace_days(now, histogram_table, emptied=days - kept)


def counted_kpis(
    spark: SparkSession,
    histogram_table: str,
    dates: Iterable[date | str] | None = None,
    run_ts: datetime | None = None,
) -> DataFrame:
    """The KPIs of some days, or of all, from the histogram alone."""
    histogram = spark.table(histogram_table)
    if dates is not None:
        histogram = date_slice(histogram, dates)
    return kpis_of(summed(histogram), run_ts)
