"""Small hand-made inputs. All times are UTC."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from parcel_engine.schemas import RAW

DAY = date(2024, 1, 15)


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def raw_row(
    event_id,
    order_id,
    courier_id,
    event_type,
    at,
    status_code=None,
    notes=None,
    ingested="2024-01-15T06:00:00",
    day=None,
):
    """One raw event; its day is that of the timestamp unless given."""
    at = utc(at)
    day = day or at.date()
    return (
        event_id, order_id, courier_id, event_type, at, None, None, status_code, notes,
        utc(ingested), day, day.year, day.month, day.day,
    )


# Ten events of four orders, with the times and codes of the known case.
EVENTS = [
    ("evt-001", "order-1", "courier-A", "pickup", "2024-01-14T08:00:00"),
    ("evt-002", "order-1", "courier-A", "in-transit", "2024-01-14T12:00:00"),
    ("evt-003", "order-1", "courier-A", "delivered", "2024-01-15T08:00:00"),
    ("evt-004", "order-2", "courier-B", "pickup", "2024-01-13T06:00:00"),
    ("evt-005", "order-2", "courier-B", "delivered", "2024-01-15T18:00:00", "CD001"),
    ("evt-006", "order-3", "courier-C", "pickup", "2024-01-15T07:00:00"),
    ("evt-006", "order-3", "courier-C", "pickup", "2024-01-15T07:05:00", None, "retry",
     "2024-01-15T06:05:00"),
    ("evt-007", "order-3", "courier-C", "failed", "2024-01-15T09:00:00", "AI001"),
    ("evt-008", "order-4", "courier-D", "pickup", "2024-01-15T10:00:00"),
    ("evt-009", "order-4", "courier-D", "in-transit", "2024-01-15T11:00:00"),
]


def raw_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RAW)


def four_orders(spark: SparkSession, one_day: bool = True) -> DataFrame:
    """The ten events; all on one day, or each on the day of its timestamp."""
    day = {"day": DAY} if one_day else {}
    return raw_frame(spark, [raw_row(*e, **day) for e in EVENTS])
