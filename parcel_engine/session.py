"""Helpers around the caller's session: scoped settings, shared folder, staged tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UCT", "Etc/UCT", "Zulu"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply session settings for one block and put the old values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def require_utc(spark: SparkSession) -> None:
    """``event_date`` and the batch clock are UTC, so the session must be as well."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def instant(ts: datetime) -> datetime:
    """A timezone-aware datetime; naive input is taken as UTC."""
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts


def batch_clock(run_ts: datetime | None) -> Column:
    """The fixed timestamp a run stamps on its rows; the query's own start if not given."""
    return F.current_timestamp() if run_ts is None else F.lit(instant(run_ts))


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, else the warehouse.

    A warehouse in local files serves in local mode alone: on a cluster it would be a folder of the
    driver's own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        own = root.startswith(("file:", "/"))
        if own and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return root.rstrip("/")


class Stage:
    """Intermediate results, each computed once and written as a Parquet table.

    Later steps read only the columns they need, see true sizes when Spark chooses a
    join strategy, and do not recompute the input when an executor is lost.
    """

    def __init__(self, spark: SparkSession, database: str):
        self._spark = spark
        self._database = database
        self._count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self._count += 1
        table = f"{self._database}.step_{self._count}"
        df.write.format("parquet").saveAsTable(table)
        return self._spark.table(table)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """A database in the shared folder for the length of one job, dropped at its end."""
    database = f"parcel_stage_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_root(spark)}/{database}'")
    try:
        yield Stage(spark, database)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
