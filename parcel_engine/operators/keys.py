"""Semi join that a hot key cannot pile onto one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 4


def rows_with_keys(
    rows: DataFrame, keys: DataFrame, key: str, slices: int = SLICES
) -> DataFrame:
    """Rows of ``rows`` whose ``key`` is in ``keys`` (one column, distinct, non-null use).

    ``rows`` is spread over ``slices`` parts per key and ``keys``, the narrow side, is
    repeated once per part. Both sides are shuffled for this join alone, so adaptive
    execution can split a partition further if one key still dominates it. When ``keys``
    turns out small, Spark broadcasts it by its measured size instead.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(slices)).cast("int")
    repeated = keys.select(
        F.col(key), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_part")
    )
    return (
        rows.withColumn("_part", part)
        .join(repeated, [key, "_part"], "left_semi")
        .drop("_part")
    )
