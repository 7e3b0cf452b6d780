"""Update-or-insert on plain Parquet tables: an anti join and a rewrite of the days hit."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_engine.session import staging
from parcel_engine.sinks.key_sketch import KeySketch
from parcel_engine.sinks.tables import (
    PARTITION,
    SKETCH,
    append,
    drop_partitions,
    ensure_table,
    partitions,
    properties,
    replace_days,
    row_counts,
)
from parcel_engine.sources.tables import date_slice


class UpsertResult(NamedTuple):
    rows: int
    dates: set[date]


def upsert(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: str | None = None,
    check_unique: bool = True,
    target_days: Iterable[date] | None = None,
    on_change: Callable[[DataFrame, DataFrame, set[date]], None] | None = None,
) -> UpsertResult:
    """Merge ``source`` into ``table``, which is partitioned by ``event_date``.

    A target row whose keys all equal those of a source row is replaced in every column;
    other source rows are inserted. Null keys equal nothing, so they always insert. With
    ``order_by``, a source row older than its match is ignored. A missing table is
    created. Running the same source again changes nothing.

    Returns the number of source rows applied and the days whose content may have changed.
    ``on_change`` is called before the table changes, with the rows that will be replaced, those
    that take their place or are new, and these days.

    The source is computed once, into a staged table. Of the target, only keys and days
    are read to find the matches, and where the caller knows the ``target_days`` that may
    hold one, or key filters tell, only of these; only days that hold a match are rewritten, and rows
    for other days are appended. A day left without rows is dropped. Into an empty table
    a source that needs no check is written directly.

    The order is append, rewrite, drop: after a failure in between, moved rows may be there
    twice until the same source is run again, which finds both copies and repairs them.
    No failure loses a row: a rewritten day is complete before its partition is switched to
    it (see ``replace_days``), and a day is dropped only when its rows stand elsewhere.
    """
    keys = list(keys)
    spark = source.sparkSession
    with staging(spark) as stage:
        if not spark.catalog.tableExists(table):
            ensure_table(spark, table, source.schema)
        if not check_unique and on_change is None and not partitions(spark, table):
            rows = append(_with_days(source), table)["rows"]
            return UpsertResult(rows, partitions(spark, table))
        staged = stage.keep(source)
        if check_unique:
            _require_unique(staged, keys)
        target = spark.table(table)
        if target_days is None:
            target_days = _days_of_keys(staged, table, keys)
        if target_days is not None:
            target = date_slice(target, target_days)
        if order_by is not None:
            staged = stage.keep(_not_older(staged, target, keys, order_by))
        incoming = row_counts(staged)
        if None in incoming:
            raise ValueError(f"{PARTITION} must not be null")
        if not incoming:
            return UpsertResult(0, set())
        matched, emptied = _match_days(staged, target, keys, set(incoming))
        if on_change is not None:
            on_change(_replaced(staged, target, keys, matched), staged, matched | set(incoming))
        _apply(staged, table, keys, matched, set(incoming), emptied - set(incoming))
    return UpsertResult(sum(incoming.values()), matched | set(incoming))


def _days_of_keys(source: DataFrame, table: str, keys: list[str]) -> set[date] | None:
    """Days that may hold a match, by the table's filters of these keys; None if it has none."""
    if SKETCH not in properties(source.sparkSession, table):
        return None
    sketch = KeySketch.of(source.sparkSession, table)
    return sketch.days_of(source.select(*keys)) if set(sketch.keys) == set(keys) else None


def _with_days(source: DataFrame) -> DataFrame:
    """The source; writing it fails on a row without a day."""
    missing = F.raise_error(F.lit(f"{PARTITION} must not be null")).cast("date")
    return source.withColumn(PARTITION, F.coalesce(PARTITION, missing))


def _require_unique(source: DataFrame, keys: list[str]) -> None:
    complete = source.filter(_complete(keys))
    repeated = complete.groupBy(*keys).count().filter(F.col("count") > 1).limit(3)
    found = [tuple(r[k] for k in keys) for r in repeated.collect()]
    if found:
        raise ValueError(f"source has several rows for one key, e.g. {found}")


def _complete(keys: list[str]) -> Column:
    complete = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        complete = complete & F.col(key).isNotNull()
    return complete


def _spread(target: DataFrame, keys: list[str]) -> DataFrame:
    """Add a join column that is 0 for complete keys and scatters rows with a null key."""
    scatter = F.xxhash64(*target.columns)
    spread = F.when(_complete(keys), F.lit(0).cast("long")).otherwise(scatter)
    return target.withColumn("_spread", spread)


def _key_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """The complete keys of the source, with the same join column."""
    return _spread(source.select(*keys).filter(_complete(keys)), keys)


def _not_older(
    source: DataFrame, target: DataFrame, keys: list[str], order_by: str
) -> DataFrame:
    current = (
        target.filter(_complete(keys))
        .groupBy(*keys)
        .agg(F.max(order_by).alias("_current"))
        .withColumn("_spread", F.lit(0).cast("long"))
    )
    return (
        _spread(source, keys)
        .join(current, [*keys, "_spread"], "left")
        .filter(F.col("_current").isNull() | (F.col(order_by) >= F.col("_current")))
        .select(*source.columns)
    )


def _match_days(
    source: DataFrame, target: DataFrame, keys: list[str], incoming: set[date]
) -> tuple[set[date], set[date]]:
    """Days of the target that hold a matched row, and those where every row is matched."""
    if PARTITION in keys:
        target = date_slice(target, incoming)
    rows = target.select(*dict.fromkeys([*keys, PARTITION]))
    hits = source.select(*keys).filter(_complete(keys)).withColumn("_hit", F.lit(True))
    found = rows.filter(_complete(keys)).join(hits, keys, "left").select(PARTITION, "_hit")
    # rows with a null key match nothing and stay out of the join
    others = rows.filter(~_complete(keys)).select(PARTITION, F.lit(None).cast("boolean").alias("_hit"))
    days = (
        found.unionByName(others)
        .groupBy(PARTITION)
        .agg(F.count("_hit").alias("hits"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("hits") > 0)
        .collect()
    )
    matched = {r[PARTITION] for r in days}
    return matched, {r[PARTITION] for r in days if r["hits"] == r["n"]}


def _replaced(
    source: DataFrame, target: DataFrame, keys: list[str], matched: set[date]
) -> DataFrame:
    """The target rows that a source row replaces; read of the days that hold one."""
    rows = date_slice(target, sorted(matched)).filter(_complete(keys))
    return rows.join(source.select(*keys).filter(_complete(keys)), keys, "left_semi")


def _apply(
    source: DataFrame,
    table: str,
    keys: list[str],
    matched: set[date],
    incoming: set[date],
    emptied: set[date],
) -> None:
    spark = source.sparkSession
    fresh = incoming - matched
    if fresh:
        append(date_slice(source, fresh), table)
    rewritten = matched - emptied
    if rewritten:
        target = spark.table(table)
        kept = (
            _spread(date_slice(target, rewritten), keys)
            .join(_key_rows(source, keys), [*keys, "_spread"], "left_anti")
            .drop("_spread")
        )
        merged = kept.unionByName(date_slice(source, rewritten).select(*target.columns))
        replace_days(merged, table)
    drop_partitions(spark, table, emptied)
