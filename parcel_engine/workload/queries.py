"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine import watermark
from parcel_engine.functions.delivery import delivery_duration_hours, is_on_time
from parcel_engine.operators import (
    courier_daily_kpis,
    dedup_latest,
    delivery_facts,
    enrich_orders,
    order_summary,
)
from parcel_engine.operators.facts import judge_orders
from parcel_engine.operators.kpis import (
    duration_histogram,
    duration_stats,
    kpi_counts,
    kpi_on_time_rate,
)
from parcel_engine.operators.sketches import (
    RANK_ERROR,
    duration_sketches,
    merged_sketches,
    sketched_quantile,
)
from parcel_engine.plans.aggregate import aggregate
from parcel_engine.plans.daily import Tables, run_daily, run_dates
from parcel_engine.plans.deltas import counted_kpis, upsert_counted
from parcel_engine.plans.ingest import ingest
from parcel_engine.plans.reconcile import reconcile
from parcel_engine.plans.transform import transform
from parcel_engine.schemas import FACT, KPI, RAW, SOURCE, WATERMARK, conform
from parcel_engine.session import session_conf, staging
from parcel_engine.sinks.key_sketch import KeySketch
from parcel_engine.sinks.order_index import OrderIndex
from parcel_engine.sinks.quarantine import accept
from parcel_engine.sinks.tables import (
    append,
    compact_partitions,
    compact_small_files,
    ensure_table,
    overwrite_partitions,
    partitions,
)
from parcel_engine.sinks.upsert import upsert
from parcel_engine.sources.cuts import cut_predicates, quantile_cuts
from parcel_engine.sources.tables import date_slice, incremental_scan
from parcel_engine.workload.lab import base_raw, fresh_table, zoneless
from parcel_engine.workload.mapping import raw_events, source_rows

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 2, 1, 6, tzinfo=timezone.utc)
WATERMARK_TS = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)
LATE_RUN_TS = datetime(2024, 1, 28, 6, tzinfo=timezone.utc)
DAY = date(2024, 1, 15)
CHANGE_DAY = date(2024, 1, 16)
BACKFILL = [date(2024, 1, 10) + timedelta(days=i) for i in range(7)]
MOVED = BACKFILL[:3]
MOVED_BY = 10
TIGHT_SLA = 24.0
THREE_DAYS = timedelta(days=3)

REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; its times are UTC whatever the session says."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with session_conf(spark, {"spark.sql.session.timeZone": "UTC"}):
                return zoneless(function(spark, sf_dir))

        REGISTRY[name] = run
        return run

    return register


def _facts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return delivery_facts(raw_events(spark, sf_dir), run_ts=RUN_TS, **options)


def _kpis(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return conform(courier_daily_kpis(_facts(spark, sf_dir, **options), RUN_TS), KPI)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = dedup_latest(raw_events(spark, sf_dir))
    return enrich_orders(latest, order_summary(latest))


# --- sources ---------------------------------------------------------------------------


@query("incremental_scan")
def incremental_scan_strict(spark, sf_dir):
    return incremental_scan(source_rows(spark, sf_dir), WATERMARK_TS)


@query("incremental_scan_overlap")
def incremental_scan_overlap(spark, sf_dir):
    raw = spark.table(base_raw(spark, sf_dir))
    return incremental_scan(raw, WATERMARK_TS, THREE_DAYS).select(*SOURCE.fieldNames())


@query("schema_conform")
def schema_conform(spark, sf_dir):
    return conform(raw_events(spark, sf_dir), SOURCE)


@query("ingest_enrich")
def ingest_enrich(spark, sf_dir):
    return raw_events(spark, sf_dir).select(*RAW.fieldNames())


@query("raw_date_slice")
def raw_date_slice(spark, sf_dir):
    return date_slice(spark.table(base_raw(spark, sf_dir)), DAY).select(*RAW.fieldNames())


@query("facts_date_slice")
def facts_date_slice(spark, sf_dir):
    table = fresh_table(spark, "sliced_facts")
    upsert(conform(_facts(spark, sf_dir), FACT), table, ["event_id"])
    return date_slice(spark.table(table), "2024-01-15").select(*FACT.fieldNames())


# --- facts -----------------------------------------------------------------------------


@query("dedup_latest")
def dedup_latest_version(spark, sf_dir):
    return dedup_latest(raw_events(spark, sf_dir)).select(*RAW.fieldNames())


@query("order_summary")
def order_summaries(spark, sf_dir):
    return order_summary(dedup_latest(raw_events(spark, sf_dir)))


@query("enrich_orders")
def enriched_orders(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "event_id", "order_id", "pickup_time", "delivery_time", "is_failed"
    )


@query("delivery_duration")
def delivery_duration(spark, sf_dir):
    hours = delivery_duration_hours().alias("delivery_duration_hours")
    return _enriched(spark, sf_dir).select("event_id", "order_id", hours)


@query("sla_flag")
def sla_flag(spark, sf_dir):
    hours = delivery_duration_hours().alias("delivery_duration_hours")
    timed = _enriched(spark, sf_dir).select("event_id", "order_id", hours)
    return timed.select("event_id", "order_id", is_on_time().alias("is_on_time"))


@query("late_reason")
def late_reason(spark, sf_dir):
    judged = judge_orders(_enriched(spark, sf_dir))
    return judged.select("event_id", "status_code", "is_failed", "is_on_time", "late_reason")


@query("delivery_facts")
def facts_by_history(spark, sf_dir):
    return _facts(spark, sf_dir)


@query("delivery_facts_by_date")
def facts_by_date(spark, sf_dir):
    return _facts(spark, sf_dir, scope="date")


# --- KPIs ------------------------------------------------------------------------------


@query("kpi_counts")
def courier_kpi_counts(spark, sf_dir):
    return kpi_counts(_facts(spark, sf_dir))


@query("kpi_on_time_rate")
def courier_on_time_rate(spark, sf_dir):
    return kpi_on_time_rate(_facts(spark, sf_dir))


@query("kpi_duration_stats")
def courier_duration_stats(spark, sf_dir):
    return duration_stats(duration_histogram(_facts(spark, sf_dir))).select(
        "courier_id", "event_date", "avg_duration_hours", "p95_duration_hours"
    )


@query("kpi_p95_approximate")
def courier_p95_approximate(spark, sf_dir):
    kpis = courier_daily_kpis(_facts(spark, sf_dir), RUN_TS, approximate_p95=True)
    return kpis.select("courier_id", "event_date", "p95_duration_hours")


@query("courier_daily_kpis")
def daily_courier_kpis(spark, sf_dir):
    return _kpis(spark, sf_dir)


# --- sinks -----------------------------------------------------------------------------


@query("ensure_table")
def ensured_table(spark, sf_dir):
    table = fresh_table(spark, "ensured")
    ensure_table(spark, table, KPI)
    append(_kpis(spark, sf_dir), table)
    return ensure_table(spark, table, KPI).select(*KPI.fieldNames())


@query("raw_append")
def raw_append(spark, sf_dir):
    table = fresh_table(spark, "appended")
    ensure_table(spark, table, RAW)
    raw = conform(raw_events(spark, sf_dir), RAW)
    append(raw.filter(F.col("event_timestamp") <= F.lit(WATERMARK_TS)), table)
    append(incremental_scan(raw, WATERMARK_TS), table)
    return spark.table(table).select(*RAW.fieldNames())


@query("overwrite_partitions")
def overwritten_partitions(spark, sf_dir):
    table = fresh_table(spark, "overwritten")
    ensure_table(spark, table, KPI)
    append(_kpis(spark, sf_dir, sla_hours=TIGHT_SLA), table)
    later = F.col("event_date") >= F.lit(CHANGE_DAY)
    overwrite_partitions(_kpis(spark, sf_dir).filter(later), table)
    return spark.table(table).select(*KPI.fieldNames())


@query("compact_partitions")
def compacted_partitions(spark, sf_dir):
    table = fresh_table(spark, "compacted")
    ensure_table(spark, table, RAW)
    raw = conform(raw_events(spark, sf_dir), RAW)
    append(raw.filter(F.col("event_timestamp") <= F.lit(WATERMARK_TS)), table)
    append(incremental_scan(raw, WATERMARK_TS), table)
    compact_partitions(spark, table, partitions(spark, table))
    return spark.table(table).select(*RAW.fieldNames())


@query("compact_small_files")
def compacted_small_files(spark, sf_dir):
    """Every day but one is compacted first, so only that one has small files left to rewrite."""
    table = fresh_table(spark, "small_files")
    ensure_table(spark, table, RAW)
    raw = conform(raw_events(spark, sf_dir), RAW)
    append(raw.filter(F.col("event_timestamp") <= F.lit(WATERMARK_TS)), table)
    append(incremental_scan(raw, WATERMARK_TS - timedelta(days=400)).filter(F.col("event_timestamp") > F.lit(WATERMARK_TS)), table)
    compact_small_files(spark, table, order_by=["courier_id", "event_timestamp"])
    append(date_slice(raw, DAY), table)
    done = compact_small_files(spark, table, order_by=["courier_id", "event_timestamp"])
    return spark.table(table).select(*RAW.fieldNames(), F.col("event_date").isin(sorted(done)).alias("rewritten"))


@query("empty_batch_noop")
def empty_batch(spark, sf_dir):
    raw, log = fresh_table(spark, "noop_raw"), fresh_table(spark, "noop_log")
    source = source_rows(spark, sf_dir)
    ingest(spark, source, raw, log, RUN_TS, start=watermark.EVERYTHING)
    ingest(spark, source, raw, log, RUN_TS, start=watermark.EVERYTHING)
    rows = spark.table(raw).select(F.lit(1).alias("raw_rows"), F.lit(0).alias("runs"))
    runs = spark.table(log).select(F.lit(0).alias("raw_rows"), F.lit(1).alias("runs"))
    return rows.union(runs).agg(F.sum("raw_rows").alias("raw_rows"), F.sum("runs").alias("runs"))


def _tight_then_late(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Load facts known at the watermark; returns the later facts to merge into them."""
    early = raw_events(spark, sf_dir).filter(
        F.col("event_timestamp") <= F.lit(WATERMARK_TS).cast("timestamp_ntz")
    )
    known = delivery_facts(early, sla_hours=TIGHT_SLA, run_ts=RUN_TS)
    upsert(conform(known, FACT), table, ["event_id"])
    late = _facts(spark, sf_dir).filter(F.col("event_date") >= F.lit(CHANGE_DAY))
    return conform(late, FACT)


@query("upsert_facts")
def upsert_facts(spark, sf_dir):
    table = fresh_table(spark, "upserted")
    upsert(_tight_then_late(spark, sf_dir, table), table, ["event_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("upsert_idempotent")
def upsert_idempotent(spark, sf_dir):
    table = fresh_table(spark, "upserted_twice")
    late = _tight_then_late(spark, sf_dir, table)
    upsert(late, table, ["event_id"])
    upsert(late, table, ["event_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("upsert_moved_partition")
def upsert_moved_partition(spark, sf_dir):
    table = fresh_table(spark, "moved")
    upsert(conform(_facts(spark, sf_dir), FACT), table, ["event_id"])
    moved = date_slice(_facts(spark, sf_dir), MOVED).withColumn(
        "event_date", F.date_add("event_date", MOVED_BY)
    )
    upsert(conform(moved, FACT), table, ["event_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("upsert_composite_key")
def upsert_composite_key(spark, sf_dir):
    table = fresh_table(spark, "merged_kpis")
    keys = ["courier_id", "event_date"]
    tight = _kpis(spark, sf_dir, sla_hours=TIGHT_SLA)
    upsert(tight.filter(F.col("event_date") <= F.lit(WATERMARK_TS.date())), table, keys)
    later = F.col("event_date") >= F.lit(CHANGE_DAY)
    upsert(_kpis(spark, sf_dir).filter(later), table, keys)
    return spark.table(table).select(*KPI.fieldNames())


@query("upsert_first_load")
def upsert_first_load(spark, sf_dir):
    table = fresh_table(spark, "first_load")
    upsert(conform(_facts(spark, sf_dir), FACT), table, ["event_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("upsert_newer_only")
def upsert_newer_only(spark, sf_dir):
    table = fresh_table(spark, "newer_only")
    upsert(conform(_facts(spark, sf_dir), FACT), table, ["event_id"])
    first = raw_events(spark, sf_dir).filter(F.col("notes").isNull())
    stale = delivery_facts(first, sla_hours=TIGHT_SLA, run_ts=RUN_TS)
    upsert(conform(stale, FACT), table, ["event_id"], order_by="event_timestamp")
    return spark.table(table).select(*FACT.fieldNames())


# --- watermark and jobs ----------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A watermark log derived from the events: a job per event type, a row per day."""
    table = fresh_table(spark, name)
    ensure_table(spark, table, WATERMARK, partition_by=None)
    rows = (
        raw_events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("job"), "event_date")
        .agg(F.max("event_timestamp").alias("watermark_ts"))
        .withColumn("run_date", F.col("event_date").cast("string"))
    )
    append(conform(rows, WATERMARK), table)
    return table


@query("watermark_latest")
def watermark_latest(spark, sf_dir):
    log = spark.table(_log(spark, sf_dir, "log_latest"))
    return watermark.latest_watermark(log, "delivered")


@query("watermark_fallback")
def watermark_fallback(spark, sf_dir):
    log = _log(spark, sf_dir, "log_fallback")
    since, _ = watermark.current(spark, log, LATE_RUN_TS, job="a job not in the log")
    return incremental_scan(source_rows(spark, sf_dir), since)


def _first_source(source: DataFrame) -> DataFrame:
    """What the source holds at the first run's time; resent copies reach it only later."""
    until = F.lit(WATERMARK_TS).cast("timestamp_ntz")
    return source.filter((F.col("event_timestamp") <= until) & F.col("notes").isNull())


def _two_runs(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """Ingest the first source, then all of it."""
    raw, log = fresh_table(spark, f"{name}_raw"), fresh_table(spark, f"{name}_log")
    source = source_rows(spark, sf_dir)
    month = timedelta(days=30)
    ingest(spark, _first_source(source), raw, log, WATERMARK_TS, lookback=month)
    ingest(spark, source, raw, log, RUN_TS)
    return raw, log


@query("watermark_update")
def watermark_update(spark, sf_dir):
    _, log = _two_runs(spark, sf_dir, "update")
    return spark.table(log)


@query("ingest_increment")
def ingest_increment(spark, sf_dir):
    raw, _ = _two_runs(spark, sf_dir, "increment")
    return spark.table(raw).select(*RAW.fieldNames())


@query("transform_one_day")
def transform_one_day(spark, sf_dir):
    facts = fresh_table(spark, "one_day_facts")
    transform(spark, base_raw(spark, sf_dir), facts, [DAY], run_ts=RUN_TS)
    return spark.table(facts).select(*FACT.fieldNames())


@query("aggregate_all_days")
def aggregate_all_days(spark, sf_dir):
    facts, kpis = fresh_table(spark, "all_facts"), fresh_table(spark, "all_kpis")
    transform(spark, base_raw(spark, sf_dir), facts, run_ts=RUN_TS)
    aggregate(spark, facts, kpis, run_ts=RUN_TS)
    return spark.table(kpis).select(*KPI.fieldNames())


@query("backfill_range")
def backfill_range(spark, sf_dir):
    raw = base_raw(spark, sf_dir)
    facts, kpis = fresh_table(spark, "range_facts"), fresh_table(spark, "range_kpis")
    run_dates(spark, Tables(raw=raw, facts=facts, kpis=kpis), BACKFILL, run_ts=RUN_TS)
    return spark.table(kpis).select(*KPI.fieldNames())


@query("backfill_range_by_date")
def backfill_range_by_date(spark, sf_dir):
    raw = base_raw(spark, sf_dir)
    facts, kpis = fresh_table(spark, "dated_facts"), fresh_table(spark, "dated_kpis")
    tables = Tables(raw=raw, facts=facts, kpis=kpis)
    run_dates(spark, tables, BACKFILL, run_ts=RUN_TS, scope="date")
    return spark.table(kpis).select(*KPI.fieldNames())


@query("daily_runs")
def daily_runs(spark, sf_dir):
    names = ("raw", "facts", "kpis", "watermarks")
    tables = Tables(**{n: fresh_table(spark, f"daily_{n}") for n in names})
    source = source_rows(spark, sf_dir)
    month = {"lookback": timedelta(days=30)}
    run_daily(spark, _first_source(source), tables, WATERMARK_TS, ingest_options=month)
    every = {"start": watermark.EVERYTHING}
    run_daily(spark, source, tables, RUN_TS, ingest_options=every)
    return spark.table(tables.kpis).drop("_aggregated_at")


# --- order index, KPI deltas, reconciliation, sketches, quarantine, cuts ---------------


@query("order_index")
def order_index(spark, sf_dir):
    """Built between two ingests, so the second extends it; both of its sides."""
    raw, log = fresh_table(spark, "indexed_raw"), fresh_table(spark, "indexed_log")
    source = source_rows(spark, sf_dir)
    ingest(spark, _first_source(source), raw, log, WATERMARK_TS, lookback=timedelta(days=30))
    index = OrderIndex.build(spark, raw)
    ingest(spark, source, raw, log, RUN_TS)
    sides = [index.entries(side).withColumn("side", F.lit(side)) for side in ("event", "order")]
    return sides[0].unionByName(sides[1])


@query("upsert_by_key_sketch")
def upsert_by_key_sketch(spark, sf_dir):
    """Facts that move to other days; filters of the keys say which days to search."""
    table = fresh_table(spark, "sketched")
    upsert(conform(_facts(spark, sf_dir), FACT), table, ["event_id"])
    KeySketch.build(spark, table, ["event_id"], bits=16)
    moved = date_slice(_facts(spark, sf_dir), MOVED).withColumn(
        "event_date", F.date_add("event_date", MOVED_BY)
    )
    upsert(conform(moved, FACT), table, ["event_id"])
    return spark.table(table).select(*FACT.fieldNames())


@query("kpi_signed_deltas")
def kpi_signed_deltas(spark, sf_dir):
    """KPIs from the histogram after three upserts: first load, late facts, facts that move."""
    facts, histogram = fresh_table(spark, "counted_facts"), fresh_table(spark, "histogram")
    early = raw_events(spark, sf_dir).filter(
        F.col("event_timestamp") <= F.lit(WATERMARK_TS).cast("timestamp_ntz")
    )
    known = delivery_facts(early, sla_hours=TIGHT_SLA, run_ts=RUN_TS)
    late = _facts(spark, sf_dir).filter(F.col("event_date") >= F.lit(CHANGE_DAY))
    moved = date_slice(_facts(spark, sf_dir), MOVED).withColumn(
        "event_date", F.date_add("event_date", MOVED_BY)
    )
    for batch in (known, late, moved):
        upsert_counted(conform(batch, FACT), facts, histogram)
    return conform(counted_kpis(spark, histogram, run_ts=RUN_TS), KPI)


@query("reconcile_raw")
def reconcile_raw(spark, sf_dir):
    """Raw after runs that lost late rows, made whole by comparing checksums."""
    raw, log = fresh_table(spark, "checked_raw"), fresh_table(spark, "checked_log")
    source = source_rows(spark, sf_dir)
    ingest(spark, _first_source(source), raw, log, WATERMARK_TS, lookback=timedelta(days=30))
    ingest(spark, source, raw, log, RUN_TS, overlap=timedelta(0))
    reconcile(spark, source, raw, RUN_TS)
    return spark.table(raw).select(*RAW.fieldNames())


@query("kpi_weekly_sketch")
def kpi_weekly_sketch(spark, sf_dir):
    """Merged daily sketches: is the weekly 95th percentile within the stated error of rank?"""
    facts = _facts(spark, sf_dir)
    week = F.to_date(F.date_trunc("week", "event_date"))
    weekly = merged_sketches(duration_sketches(facts).withColumn("week", week), ["courier_id", "week"])
    found = sketched_quantile(weekly)
    hours = F.col("delivery_duration_hours")
    timed = facts.filter(hours.isNotNull()).select("courier_id", week.alias("week"), hours)
    ranks = timed.join(found, ["courier_id", "week"]).groupBy("courier_id", "week", "timed").agg(
        F.avg((hours < F.col("p95_duration_hours")).cast("int")).alias("below"),
        F.avg((hours <= F.col("p95_duration_hours")).cast("int")).alias("up_to"),
    )
    near = (F.col("below") - RANK_ERROR <= 0.95) & (F.col("up_to") + RANK_ERROR >= 0.95)
    return ranks.select("courier_id", "week", "timed", near.alias("within"))


def _untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source as text, with values that do not fit: times, places and types of some events."""
    rows = source_rows(spark, sf_dir)
    number = F.col("event_id").cast("long")
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    return text.withColumns(
        {
            "event_timestamp": F.when(number % 97 == 0, F.lit("soon")).otherwise(F.col("event_timestamp")),
            "location_lat": F.when(number % 89 == 0, F.lit("north")).otherwise(F.col("location_lat")),
            "event_type": F.when(number % 101 != 0, F.col("event_type")),
        }
    )


@query("quarantine_accepted")
def quarantine_accepted(spark, sf_dir):
    table, kept = fresh_table(spark, "refused"), fresh_table(spark, "accepted")
    with staging(spark) as stage:
        accept(_untyped(spark, sf_dir), SOURCE, table, stage, RUN_TS).write.saveAsTable(kept)
    return spark.table(kept)


@query("quarantine_refused")
def quarantine_refused(spark, sf_dir):
    table = fresh_table(spark, "refused_only")
    with staging(spark) as stage:
        accept(_untyped(spark, sf_dir), SOURCE, table, stage, RUN_TS)
    problem = spark.table(table).select("row", F.explode("problems").alias("problem"))
    event = F.get_json_object("row", "$.event_id").alias("event_id")
    return problem.select(event, "problem.column", "problem.reason", "problem.value")


@query("scan_by_quantile")
def scan_by_quantile(spark, sf_dir):
    """A scan cut by quantiles of a column: whole, each row once, parts of like size."""
    rows = source_rows(spark, sf_dir)
    predicates = cut_predicates("location_lat", quantile_cuts(rows, "location_lat", 8))
    parts = [rows.filter(p).select("event_id", F.lit(i).alias("part")) for i, p in enumerate(predicates)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    sizes = every.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    balanced = F.max("n") < 2 * F.percentile("n", 0.5)
    return sizes.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("parts"), balanced.alias("balanced"))
