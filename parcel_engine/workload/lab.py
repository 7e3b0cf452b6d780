"""Tables for the registered queries: a database per application in the shared folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from parcel_engine.schemas import RAW, conform
from parcel_engine.session import shared_root
from parcel_engine.sinks.tables import append, ensure_table
from parcel_engine.workload.mapping import raw_events


def _plain(text: str) -> str:
    return re.sub(r"\W+", "_", text).strip("_").lower()


def database(spark: SparkSession) -> str:
    name = f"parcel_{_plain(spark.sparkContext.applicationId)}"
    location = f"{shared_root(spark)}/{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def fresh_table(spark: SparkSession, name: str) -> str:
    """The name of a table that does not exist yet; what an earlier call left is dropped."""
    table = f"{database(spark)}.{name}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return table


def base_raw(spark: SparkSession, sf_dir: str) -> str:
    """The raw table of one data folder, loaded on first use and shared by the queries."""
    table = f"{database(spark)}.raw_{_plain(sf_dir)}"
    if not spark.catalog.tableExists(table):
        ensure_table(spark, table, RAW)
        append(conform(raw_events(spark, sf_dir), RAW), table)
    return table


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as SQL ``TIMESTAMP`` has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
