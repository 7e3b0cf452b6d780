"""Cuts for parallel scans that follow the data instead of equal ranges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 100_000


def quantile_cuts(rows: DataFrame, column: str, parts: int, sample_rows: int = SAMPLE_ROWS) -> list:
    """At most ``parts - 1`` ascending values that cut the rows into parts of about one size.

    For numbers, dates and timestamps. The quantiles are those of a random sample of some
    ``sample_rows`` rows; the aggregate that finds them has bounded state. A value that alone
    holds several parts is one cut, so the parts are fewer.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    known = rows.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
    total = known.count()
    if total > sample_rows:
        known = known.sample(fraction=sample_rows / total, seed=7)
    wanted = [i / parts for i in range(1, parts)]
    found = known.agg(F.percentile_approx("v", wanted or [0.5], 10_000)).first()[0] if wanted else None
    return sorted(set(found or []))


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return repr(value)


def cut_predicates(column: str, cuts: Sequence) -> list[str]:
    """SQL conditions that cover every row exactly once, for ``jdbc_predicate_scan`` or filters.

    A row on a cut belongs to the part above it; nulls are in the first part.
    """
    if not cuts:
        return ["1 = 1"]
    edges = [_literal(c) for c in cuts]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]
