"""Durations as mergeable quantile sketches: any range of days without reading its facts again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.operators.kpis import DAY, P95

#: Size of a sketch: at most some hundreds of values, whatever the number of events.
SKETCH_K = 400
#: The rank of a sketched quantile is off by less than this share of the values. The sketches
#: are randomised; at this size an error of a third of it is met with 99 per cent certainty.
RANK_ERROR = 0.02


def duration_sketches(facts: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per courier and day: ``timed`` events with a duration, and the sketch of these durations."""
    timed = facts.filter(F.col("delivery_duration_hours").isNotNull())
    return timed.groupBy(*DAY).agg(
        F.count(F.lit(1)).alias("timed"),
        F.kll_sketch_agg_double("delivery_duration_hours", F.lit(k)).alias("sketch"),
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, such as weeks; merging costs no more than the sketches' size."""
    return sketches.groupBy(*by).agg(
        F.sum("timed").alias("timed"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def sketched_quantile(sketches: DataFrame, quantile: float = P95, name: str = "p95_duration_hours") -> DataFrame:
    """The quantile of each sketch, by rank within ``RANK_ERROR``."""
    return sketches.withColumn(name, F.kll_sketch_get_quantile_double("sketch", F.lit(quantile))).drop("sketch")
