"""Delivery events from a relational database through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from parcel_engine.schemas import SOURCE, ddl

FETCH_SIZE = 10_000
NUM_PARTITIONS = 8


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int = FETCH_SIZE,
    schema: StructType = SOURCE,
) -> dict[str, str]:
    """Options of a single-connection scan. ``table`` may be a sub-query with an alias."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "customSchema": ddl(schema),
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def range_options(
    lower: datetime | int,
    upper: datetime | int,
    column: str = "event_timestamp",
    num_partitions: int = NUM_PARTITIONS,
) -> dict[str, str]:
    """Options that cut the scan into ranges of a numeric, date or timestamp column.

    The bounds only place the cuts: rows outside them fall into the first or last range,
    so the result is whole whatever they are.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be at least 1")
    if not lower < upper:
        raise ValueError("lower bound must be below upper bound")
    text = [
        v.strftime("%Y-%m-%d %H:%M:%S") if isinstance(v, datetime) else str(v)
        for v in (lower, upper)
    ]
    return {
        "partitionColumn": column,
        "lowerBound": text[0],
        "upperBound": text[1],
        "numPartitions": str(num_partitions),
    }


def jdbc_scan(spark: SparkSession, url: str, table: str, **connection) -> DataFrame:
    """Scan over one connection. Filters on the result are pushed into the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **connection)).load()


def jdbc_partitioned_scan(
    spark: SparkSession,
    url: str,
    table: str,
    lower: datetime | int,
    upper: datetime | int,
    column: str = "event_timestamp",
    num_partitions: int = NUM_PARTITIONS,
    **connection,
) -> DataFrame:
    """Parallel scan by ranges of ``column``; each range is one task and one connection."""
    options = jdbc_options(url, table, **connection)
    options |= range_options(lower, upper, column, num_partitions)
    return spark.read.format("jdbc").options(**options).load()


def jdbc_predicate_scan(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str],
    **connection,
) -> DataFrame:
    """Parallel scan for string keys: one task per predicate.

    ``predicates`` are SQL conditions that together cover every row exactly once, such as
    ``mod(hash(event_id), 8) = 0`` and so on in the database's own dialect.
    """
    options = jdbc_options(url, table, **connection)
    url, table = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
