"""Column expressions of the delivery domain. All of them are built-in Spark functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The on-time limit in hours, and the status codes behind each late reason.
SLA_HOURS = 48.0
LATE_REASONS: dict[str, list[str]] = {
    "no_pickup": ["NP001", "NP002"],
    "courier_delay": ["CD001", "CD002", "CD003"],
    "address_issue": ["AI001", "AI002", "AI003", "AI004"],
}

# The event types that carry meaning; any other type passes through.
PICKUP, DELIVERED, FAILED = "pickup", "delivered", "failed"


def event_is(event_type: str) -> Column:
    """True for rows of one event type, false for all others including a null type."""
    return F.col("event_type").eqNullSafe(F.lit(event_type))


def delivery_duration_hours() -> Column:
    """Hours from pickup to delivery, counted in whole seconds; null if either is missing.

    May be negative when the delivery was recorded before the pickup.
    """
    seconds = F.unix_timestamp("delivery_time") - F.unix_timestamp("pickup_time")
    return seconds / F.lit(3600.0)


def is_on_time(sla_hours: float = SLA_HOURS) -> Column:
    """Duration within the limit (inclusive); null where the duration is null."""
    return F.col("delivery_duration_hours") <= F.lit(float(sla_hours))


def reason_for_status(rules: Mapping[str, Sequence[str]] = LATE_REASONS) -> Column:
    """The first rule whose list holds the row's status code; null if none does."""
    reason = F.lit(None).cast("string")
    for name, codes in reversed(list(rules.items())):
        reason = F.when(F.col("status_code").isin(list(codes)), F.lit(name)).otherwise(reason)
    return reason


def late_reason(rules: Mapping[str, Sequence[str]] = LATE_REASONS) -> Column:
    """Reason for events of late or failed orders; null for on-time and open ones."""
    return F.when(~F.col("is_on_time") | F.col("is_failed"), reason_for_status(rules))


def round2(value: Column) -> Column:
    """Two decimals, halves away from zero."""
    return F.round(value, 2)


def ratio2(total: Column, parts: Column) -> Column:
    """``total / parts`` of whole numbers with two decimals, halves away from zero; exact.

    Hundredths are found by whole division, so nothing is rounded twice and the order of
    the rows cannot matter. Null if ``parts`` is null or zero.
    """
    wide = total.cast("decimal(28,0)")
    below = F.nullif(parts, F.lit(0)).cast("decimal(20,0)")
    up = F.call_function("div", F.abs(wide) * 200 + below, below * 2)
    return F.signum(wide).cast("double") * up / 100.0
