"""Job 2: raw events to curated facts, upserted by event."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcel_engine.functions.delivery import LATE_REASONS, SLA_HOURS
from parcel_engine.operators.dedup import dedup_latest
from parcel_engine.operators.facts import delivery_facts
from parcel_engine.operators.keys import rows_with_keys
from parcel_engine.schemas import FACT, conform
from parcel_engine.session import Stage, require_utc, staging
from parcel_engine.sinks.order_index import OrderIndex
from parcel_engine.sinks.tables import partitions
from parcel_engine.sinks.upsert import UpsertResult, upsert
from parcel_engine.sources.tables import as_date, date_slice


class History:
    """The orders touched on some days, and the events that decide their facts.

    ``events`` holds the latest version of every event that was ever in such an order.
    Some of those have moved on to another order, of which the rest is not read.

    Raw is read of the given days, and of ``days``, which hold every version of these events.
    Everything in between comes from the index, and of that only the buckets of the keys.
    """

    def __init__(self, raw: DataFrame, dates: Iterable[date], stage: Stage, index: OrderIndex):
        touched = stage.keep(date_slice(raw, dates).select("event_id").distinct())
        # An event moved to another order by a correction touches both orders.
        self.orders = stage.keep(index.orders_of(touched))
        related = stage.keep(index.events_of(self.orders).unionByName(touched).distinct())
        self.days = {r["event_date"] for r in index.days_of(related).collect()}
        if None not in self.days:
            raw = date_slice(raw, self.days)
        self.events = stage.keep(dedup_latest(rows_with_keys(raw, related, "event_id")))


def last_day_wins(facts: DataFrame) -> DataFrame:
    """One fact per event when its copies lie on several days: what runs in day order leave."""
    latest = Window.partitionBy("event_id").orderBy(F.col("event_date").desc())
    return (
        facts.withColumn("_run", F.row_number().over(latest))
        .filter(F.col("_run") == 1)
        .drop("_run")
    )


def transform(
    spark: SparkSession,
    raw_table: str,
    facts_table: str,
    dates: Iterable[date | str] | None = None,
    sla_hours: float = SLA_HOURS,
    late_reasons: Mapping[str, Sequence[str]] = LATE_REASONS,
    scope: str = "history",
    run_ts: datetime | None = None,
    order_by: str | None = None,
) -> UpsertResult:
    """Recompute and upsert the facts of the given days, or of all raw events.

    ``scope="history"`` (default) recomputes every order with an event on those days from
    all of its events, so a delivery also completes the facts of earlier days.
    ``scope="date"`` uses the events of each day alone.

    When the days cover all of raw there is nothing to look up, and it is read as a whole.

    Returns the number of facts and every day whose facts may have changed.
    """
    require_utc(spark)
    raw = spark.table(raw_table)
    options = dict(
        sla_hours=sla_hours,
        late_reasons=late_reasons,
        scope=scope,
        run_ts=run_ts,
    )
    days = None if dates is None else {as_date(d) for d in dates}
    if days is not None and days >= partitions(spark, raw_table):
        days = None
    target_days = None
    with staging(spark) as stage:
        if scope == "date":
            slice_ = raw if days is None else date_slice(raw, days)
            facts = last_day_wins(delivery_facts(slice_, **options))
        elif days is None:
            facts = delivery_facts(raw, **options)
        else:
            history = History(raw, days, stage, OrderIndex.ensure(spark, raw_table))
            # a fact lies on the day of some version of its event
            target_days = history.days
            facts = delivery_facts(
                history.events, orders=history.orders, deduplicated=True, **options
            )
        return upsert(
            conform(facts, FACT),
            facts_table,
            keys=["event_id"],
            order_by=order_by,
            check_unique=False,
            target_days=target_days,
        )
