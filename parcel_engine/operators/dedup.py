"""Latest version of each event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_NEWEST_FIRST = ("event_timestamp", "_ingested_at")
_NEXT = ("order_id", "event_type")


def dedup_latest(events: DataFrame, keys: Sequence[str] = ("event_id",)) -> DataFrame:
    """One row per key: the latest ``event_timestamp``, then the latest ``_ingested_at``.

    Remaining ties are broken by the other columns, so the result does not depend on row
    order. ``order_id`` and ``event_type`` come first among those, so a projection that
    holds only the columns of the order summary keeps the same version as the full row.

    Spark turns ``row_number = 1`` into a group limit on both sides of the shuffle: each
    task sends at most one row per key, so a key with very many copies stays small.
    """
    newest = [F.col(c).desc() for c in _NEWEST_FIRST if c in events.columns]
    next_up = [c for c in _NEXT if c in events.columns and c not in keys]
    used = {*keys, *_NEWEST_FIRST, *next_up}
    ties = next_up + sorted(c for c in events.columns if c not in used)
    order = newest + [F.col(c).asc() for c in ties]
    version = Window.partitionBy(*keys).orderBy(*order)
    return (
        events.withColumn("_version", F.row_number().over(version))
        .filter(F.col("_version") == 1)
        .drop("_version")
    )
