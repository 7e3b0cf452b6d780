"""Raw events to curated facts: one row per event, with the fate of its order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.functions.delivery import (
    LATE_REASONS,
    SLA_HOURS,
    delivery_duration_hours,
    is_on_time,
    late_reason,
)
from parcel_engine.operators.dedup import dedup_latest
from parcel_engine.operators.orders import enrich_orders, order_summary
from parcel_engine.schemas import FACT
from parcel_engine.session import batch_clock

SCOPES = ("history", "date")
_SUMMARY_INPUT = ("event_id", "order_id", "event_type", "event_timestamp", "_ingested_at")


def judge_orders(
    events: DataFrame,
    sla_hours: float = SLA_HOURS,
    late_reasons: Mapping[str, Sequence[str]] = LATE_REASONS,
) -> DataFrame:
    """Duration, on-time flag and late reason of events that carry their order's summary."""
    return (
        events.withColumn("delivery_duration_hours", delivery_duration_hours())
        .withColumn("is_on_time", is_on_time(sla_hours))
        .withColumn("late_reason", late_reason(late_reasons))
    )


def delivery_facts(
    raw: DataFrame,
    sla_hours: float = SLA_HOURS,
    late_reasons: Mapping[str, Sequence[str]] = LATE_REASONS,
    scope: str = "history",
    run_ts: datetime | None = None,
    orders: DataFrame | None = None,
    deduplicated: bool = False,
) -> DataFrame:
    """The 18 fact columns for every event in ``raw``, or for those of ``orders``.

    ``scope="history"`` looks at all versions and all events of an order together.
    ``scope="date"`` treats each ``event_date`` on its own, as a run that reads a single
    day does: an order picked up one day and delivered the next gets no duration.

    The summary reads a narrow projection of the same events, so only the columns it
    needs go through its shuffles. ``deduplicated`` says that ``raw`` already holds one
    version per event, for instance because it was staged like that.

    ``orders`` (distinct ``order_id``) is applied after dedup: an event counts for the
    order of its latest version. Events without an order are always kept.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    day = ["event_date"] if scope == "date" else []
    latest, narrow = raw, raw.select(*_SUMMARY_INPUT, *day)
    if not deduplicated:
        latest = dedup_latest(latest, [*day, "event_id"])
        narrow = dedup_latest(narrow, [*day, "event_id"])
    order = [*day, "order_id"]
    summary = order_summary(narrow, order)
    if orders is not None:
        summary = summary.join(orders, "order_id", "left_semi")
    enriched = enrich_orders(latest, summary, order)
    if orders is not None:
        has_summary = F.col("is_failed").isNotNull()
        enriched = enriched.filter(has_summary | F.col("order_id").isNull())
    return (
        judge_orders(enriched, sla_hours, late_reasons)
        .withColumn("_transformed_at", batch_clock(run_ts))
        .select(*FACT.fieldNames())
    )
