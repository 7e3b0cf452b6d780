"""Per-order pickup, delivery and failure, and their way back onto every event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.functions.delivery import DELIVERED, FAILED, PICKUP, event_is
from parcel_engine.operators.keys import SLICES

SUMMARY = ("pickup_time", "delivery_time", "is_failed")


def order_summary(events: DataFrame, keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """Earliest pickup, earliest delivery and any failure of each order, plus its size.

    ``events`` must hold one version per event. All aggregates have fixed-width state
    and are combined before the shuffle.
    """
    at = F.col("event_timestamp")
    return events.groupBy(*keys).agg(
        F.min(F.when(event_is(PICKUP), at)).alias("pickup_time"),
        F.min(F.when(event_is(DELIVERED), at)).alias("delivery_time"),
        F.bool_or(event_is(FAILED)).alias("is_failed"),
        F.count(F.lit(1)).alias("event_count"),
    )


def enrich_orders(
    events: DataFrame, summary: DataFrame, keys: Sequence[str] = ("order_id",), slices: int = SLICES
) -> DataFrame:
    """Left join of every event to the summary of its order.

    Events are dealt over ``slices`` parts of their order and the summary, the narrow side,
    is repeated once per part, for all orders alike. Both sides are shuffled for this join
    alone, so adaptive execution can split a partition further if one order dominates it.
    """
    part = F.pmod(F.xxhash64("event_id", "event_timestamp"), F.lit(slices)).cast("int")
    found = summary.select(
        *keys,
        F.struct(*SUMMARY).alias("_found"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"),
    )
    joined = events.withColumn("_slice", part).join(found, [*keys, "_slice"], "left")
    return joined.select(
        *[F.col(c) for c in events.columns], *[F.col("_found")[c].alias(c) for c in SUMMARY]
    )
