"""Managed Parquet tables partitioned by day.

A day is replaced by switching its partition to a folder that is already complete, so a run that
fails at any point leaves every day as it was or as it should be. One writer at a time per table:
plain Parquet has no snapshot isolation, so a reader that runs during an overwrite may see some
days old and some new, or miss files of a day it has planned to read.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Sequence
from datetime import date

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcel_engine.session import session_conf, staging
from parcel_engine.sources.tables import as_date, date_slice

PARTITION = "event_date"
COMPACT_BYTES = 256 * 1024 * 1024
#: Folders of rewritten days within a table's folder; the underscore hides them from listings.
REWRITTEN = "_rewritten-"
#: Property of a raw table that has an order index: the index table and its number of buckets.
INDEX = "parcel.order_index"
#: Property of a table that has key filters: their table, log2 of their bits, the key columns.
SKETCH = "parcel.key_sketch"

# Microsecond timestamps, unlike the default encoding, carry the statistics that let scans skip
# row groups. The setting belongs to the session, so writers in threads take turns.
_WRITING = threading.RLock()
_WRITE_SETTINGS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: str | None = PARTITION,
) -> DataFrame:
    """The table, created empty if it does not exist."""
    if not spark.catalog.tableExists(table):
        writer = spark.createDataFrame([], schema).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.saveAsTable(table)
    return spark.table(table)


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def by_day(df: DataFrame) -> DataFrame:
    """Rows of a day next to each other, in parts of the advisory partition size.

    Adaptive execution splits a large day over many tasks and joins small ones, so the
    files come out even and one day never ends up on one task.
    """
    return df.hint("rebalance", PARTITION)


def insert(df: DataFrame, table: str, measures: Sequence[Column] = ()) -> dict:
    """Add ``df`` to ``table``, matching columns by name; returns the row count.

    The count and any further ``measures`` (named aggregates) are taken from the rows as
    the last stage writes them, so there is no second pass, and a repeated task of an
    earlier stage is not counted twice.
    """
    spark = df.sparkSession
    written = Observation()
    counted = df.select(*spark.table(table).columns).observe(
        written, F.count(F.lit(1)).alias("rows"), *measures
    )
    with _WRITING, session_conf(spark, _WRITE_SETTINGS):
        counted.write.insertInto(table)
    return written.get


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _companions(spark: SparkSession, table: str) -> list:
    """The order index and the key filters of a table, where it has them: they learn rows first."""
    known = properties(spark, table)
    if INDEX not in known and SKETCH not in known:
        return []
    from parcel_engine.sinks.key_sketch import KeySketch  # both write through this module
    from parcel_engine.sinks.order_index import OrderIndex

    return [c for c in (OrderIndex.of(spark, table), KeySketch.of(spark, table)) if c is not None]


def append(df: DataFrame, table: str, measures: Sequence[Column] = ()) -> dict:
    """Add rows; an empty batch adds nothing.

    Where the table has an order index or key filters, the batch is computed once, into a staged
    table, and enters them first.
    """
    spark = df.sparkSession
    companions = _companions(spark, table)
    if is_partitioned(spark, table):
        df = by_day(df)
    if not companions:
        return insert(df, table, measures=measures)
    with staging(spark) as stage:
        batch = stage.keep(df)
        for companion in companions:
            companion.extend(batch)
        return insert(by_day(batch), table, measures=measures)


def partitions(spark: SparkSession, table: str) -> set[date]:
    """Days that have a partition, from the catalog alone."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {as_date(r[0].split("=", 1)[1]) for r in rows}


def drop_partitions(spark: SparkSession, table: str, dates: Iterable[date]) -> None:
    specs = ", ".join(f"PARTITION ({PARTITION} = DATE'{d}')" for d in sorted(dates))
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def table_folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def remove_folder(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def _day_folders(spark: SparkSession, table: str, dates: Iterable[date]) -> set[str]:
    """Folders that hold files of the days; only these partitions are listed."""
    return {f.rsplit("/", 1)[0] for f in date_slice(spark.table(table), sorted(dates)).inputFiles()}


def _switch(spark: SparkSession, table: str, day: date, folder: str) -> None:
    """Let the partition of a day point to another folder; one change of the catalog."""
    spec = f"PARTITION ({PARTITION} = DATE'{day}')"
    spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")


class IncompleteWrite(RuntimeError):
    """A rewritten day does not hold the rows that were written."""


def replace_days(
    df: DataFrame,
    table: str,
    emptied: Iterable[date] = (),
    same_rows: bool = False,
    order_by: Sequence[str] = (),
) -> int:
    """Replace exactly the days present in ``df``; drop those ``emptied``; returns the rows.

    All rows go to a fresh folder below the table's, hidden from anything that lists the table.
    Only when the files hold as many rows of each day as were written, the partitions of the days
    are switched to it, one by one, and the folders they had are removed last.

    A failure before the switch changes nothing, and one among the switches leaves each day with
    either all its old or all its new rows. What a failed run has left in the table's folder,
    ``sweep`` removes. ``same_rows`` says that the rows are those the table has, so an order index
    or key filters learn nothing from them. Within its files a day is sorted by ``order_by``, so that
    scans skip row groups by these columns.
    """
    spark = df.sparkSession
    companions = [] if same_rows else _companions(spark, table)
    present = partitions(spark, table)
    fresh = f"{table_folder(spark, table)}/{REWRITTEN}{uuid4().hex}"
    written = Observation()
    rows = by_day(df.select(*spark.table(table).columns))
    if order_by:
        rows = rows.sortWithinPartitions(PARTITION, *order_by)
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    with _WRITING, session_conf(spark, _WRITE_SETTINGS):
        rows.write.partitionBy(PARTITION).parquet(fresh)
    if written.get["rows"]:
        schema = spark.table(table).schema
        rewritten = spark.read.schema(schema).parquet(fresh)
        found = row_counts(rewritten)
        if None in found or sum(found.values()) != written.get["rows"]:
            raise IncompleteWrite(f"{fresh} holds {sum(found.values())} rows, not {written.get['rows']}")
        for companion in companions:
            companion.extend(rewritten)
        before = _day_folders(spark, table, found.keys() & present)
        added = " ".join(f"PARTITION ({PARTITION} = DATE'{d}') LOCATION '{fresh}/{PARTITION}={d}'" for d in sorted(found.keys() - present))
        if added:
            spark.sql(f"ALTER TABLE {table} ADD {added}")
        for day in sorted(found.keys() & present):
            _switch(spark, table, day, f"{fresh}/{PARTITION}={day}")
        spark.catalog.refreshTable(table)
        for folder in before:
            remove_folder(spark, folder)
    drop_partitions(spark, table, emptied)
    return written.get["rows"]


def sweep(spark: SparkSession, table: str) -> list[str]:
    """Remove rewritten folders that no partition points to; no writer may be at work."""
    root = table_folder(spark, table)
    files, location = _file_system(spark, root)
    used = {f.split("/")[-3] for f in spark.table(table).inputFiles()}
    names = [status.getPath().getName() for status in files.listStatus(location)]
    gone = sorted(n for n in names if n.startswith(REWRITTEN) and n not in used)
    for name in gone:
        remove_folder(spark, f"{root}/{name}")
    return gone


def overwrite_partitions(
    df: DataFrame, table: str, emptied: Iterable[date | str] = ()
) -> int:
    """Replace exactly the days present in ``df``, and drop those named in ``emptied``.

    Days without rows in ``df`` stay as they are unless they are named.
    """
    return replace_days(df, table, {as_date(d) for d in emptied})


def compact_partitions(
    spark: SparkSession,
    table: str,
    dates: Iterable[date | str],
    file_bytes: int = COMPACT_BYTES,
    order_by: Sequence[str] = (),
) -> int:
    """Rewrite the days with files of about ``file_bytes``; the rows stay the same."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{file_bytes}b"}
    with session_conf(spark, settings):
        days = date_slice(spark.table(table), dates)
        return replace_days(days, table, same_rows=True, order_by=order_by)


def days_of_small_files(
    spark: SparkSession, table: str, file_bytes: int = COMPACT_BYTES, least: int = 2
) -> set[date]:
    """Days with at least ``least`` files below half of ``file_bytes``, which fewer could hold.

    Sizes come with the scan of no columns; per file one row is left after the first step.
    """
    files = spark.table(table).select(PARTITION, "_metadata.file_path", "_metadata.file_size").distinct()
    small = files.filter(F.col("file_size") < file_bytes // 2)
    found = small.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return {r[PARTITION] for r in found.collect()}


def compact_small_files(
    spark: SparkSession, table: str, file_bytes: int = COMPACT_BYTES, order_by: Sequence[str] = ()
) -> set[date]:
    """Compact the days that have small files and leave all others as they are; returns the days."""
    days = days_of_small_files(spark, table, file_bytes)
    if days:
        compact_partitions(spark, table, days, file_bytes, order_by)
    return days


def row_counts(df: DataFrame) -> dict[date, int]:
    """Rows per day; the result is bounded by the number of days."""
    counts = df.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[PARTITION]: r["n"] for r in counts}
