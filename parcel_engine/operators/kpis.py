"""Curated facts to daily KPIs per courier."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcel_engine.functions.delivery import DELIVERED, event_is, ratio2, round2
from parcel_engine.schemas import KPI
from parcel_engine.session import batch_clock

DAY = ("courier_id", "event_date")
P95 = 0.95

_COUNTS = ("total_deliveries", "delivered_count", "failed_count", "on_time_count")
#: What a histogram counts; the last is events with a verdict.
HISTOGRAM_COUNTS = (*_COUNTS, "_judged")


def _counts() -> list[Column]:
    """Event counts; a null flag counts as not set."""
    return [
        F.count(F.lit(1)).alias("total_deliveries"),
        F.count_if(event_is(DELIVERED)).alias("delivered_count"),
        F.count_if(F.col("is_failed")).alias("failed_count"),
        F.count_if(F.col("is_on_time")).alias("on_time_count"),
        F.count("is_on_time").alias("_judged"),
    ]


def _rate(on_time: Column, judged: Column) -> Column:
    """Share of on-time events among those with a verdict; null if there is none."""
    return ratio2(on_time * 100, judged)


def kpi_counts(facts: DataFrame) -> DataFrame:
    """The four event counts per courier and day."""
    return facts.groupBy(*DAY).agg(*_counts()).select(*DAY, *_COUNTS)


def kpi_on_time_rate(facts: DataFrame) -> DataFrame:
    """Per cent of on-time events per courier and day."""
    rate = _rate(F.col("on_time_count"), F.col("_judged")).alias("on_time_rate_pct")
    return facts.groupBy(*DAY).agg(*_counts()).select(*DAY, rate)


def duration_histogram(facts: DataFrame) -> DataFrame:
    """All KPI inputs, added up per courier, day and duration.

    Durations are whole seconds, and all events of an order share one, so this is much
    smaller than the facts. It splits a courier-day of any size over many tasks: what is
    left per courier-day is one row per distinct duration.
    """
    return facts.groupBy(*DAY, "delivery_duration_hours").agg(*_counts())


def duration_stats(histogram: DataFrame, percentile: float = P95) -> DataFrame:
    """Totals, mean duration and the exact discrete percentile from the histogram."""
    hours = F.col("delivery_duration_hours")
    weight = F.when(hours.isNotNull(), F.col("total_deliveries")).otherwise(F.lit(0))
    courier_day = Window.partitionBy(*DAY)
    so_far = courier_day.orderBy(hours).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        histogram.withColumn("_timed", weight)
        .withColumn("_rank", F.sum("_timed").over(so_far))
        .withColumn("_all", F.sum("_timed").over(courier_day))
    )
    reached = F.col("_rank") >= F.ceil(F.lit(percentile) * F.col("_all"))
    # durations are whole seconds, so they are added up as whole numbers
    seconds = F.round(hours * 3600).cast("long").cast("decimal(20,0)") * F.col("_timed")
    mean = ratio2(F.sum(seconds), F.sum("_timed") * 3600)
    return ranked.groupBy(*DAY).agg(
        *[F.sum(c).alias(c) for c in HISTOGRAM_COUNTS],
        mean.alias("avg_duration_hours"),
        round2(F.min(F.when(reached, hours))).alias("p95_duration_hours"),
    )


def courier_daily_kpis(
    facts: DataFrame,
    run_ts: datetime | None = None,
    approximate_p95: bool = False,
) -> DataFrame:
    """One row per courier and day with the ten KPI columns.

    The counts, the rate, the mean and the percentile are weighted by event: every event
    of an order carries the order's flags and duration.

    By default the 95th percentile is exact. ``approximate_p95=True`` asks Spark's
    ``percentile_approx`` (default accuracy) for it in a single aggregation: one shuffle
    less, but every task then sends a sketch of up to 10,000 values per courier-day.
    """
    if approximate_p95:
        hours = F.col("delivery_duration_hours")
        daily = facts.groupBy(*DAY).agg(
            *_counts(),
            round2(F.avg(hours)).alias("avg_duration_hours"),
            round2(F.percentile_approx(hours, P95)).alias("p95_duration_hours"),
        )
        return _finished(daily, run_ts)
    return kpis_of(duration_histogram(facts), run_ts)


def kpis_of(histogram: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """The ten KPI columns from a histogram of durations."""
    return _finished(duration_stats(histogram), run_ts)


def _finished(daily: DataFrame, run_ts: datetime | None) -> DataFrame:
    rate = _rate(F.col("on_time_count"), F.col("_judged"))
    return (
        daily.withColumn("on_time_rate_pct", rate)
        .withColumn("_aggregated_at", batch_clock(run_ts))
        .select(*KPI.fieldNames())
    )
