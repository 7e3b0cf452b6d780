"""The same results in SQL, written from the rules rather than from the Spark code."""

from __future__ import annotations

from parcel_engine.workload import queries as q
from parcel_engine.workload.mapping import RAW_SQL

SOURCE_COLUMNS = (
    "event_id, order_id, courier_id, event_type, event_timestamp, "
    "location_lat, location_lon, status_code, notes"
)
RAW_COLUMNS = f"{SOURCE_COLUMNS}, _ingested_at, event_date, year, month, day"


def _ts(value) -> str:
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"


RUN_TS, WATERMARK = _ts(q.RUN_TS), _ts(q.WATERMARK_TS)
DAYS = ", ".join(f"DATE '{d}'" for d in q.BACKFILL)
MOVED_DAYS = ", ".join(f"DATE '{d}'" for d in q.MOVED)


def _latest(source: str, name: str, by: str = "event_id") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (version) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {by} ORDER BY event_timestamp DESC, _ingested_at DESC) AS version
    FROM {source})
  WHERE version = 1
)"""


def _summary(source: str, name: str, by: str = "order_id") -> str:
    return f"""{name} AS (
  SELECT {by},
         min(event_timestamp) FILTER (WHERE event_type = 'pickup') AS pickup_time,
         min(event_timestamp) FILTER (WHERE event_type = 'delivered') AS delivery_time,
         bool_or(event_type = 'failed') AS is_failed,
         count(*) AS event_count
  FROM {source} GROUP BY {by}
)"""


_HOURS = """date_diff('second', date_trunc('second', pickup_time),
           date_trunc('second', delivery_time)) / 3600.0"""

_REASON = """CASE WHEN status_code IN ('NP001', 'NP002') THEN 'no_pickup'
              WHEN status_code IN ('CD001', 'CD002', 'CD003') THEN 'courier_delay'
              WHEN status_code IN ('AI001', 'AI002', 'AI003', 'AI004') THEN 'address_issue'
         END"""


def _facts(source: str, name: str, sla: float = 48.0, by: str = "") -> str:
    """Common table expressions from versions of events to the 18 fact columns."""
    event, order = f"{by}event_id", f"{by}order_id"
    return f"""{_latest(source, name + "_latest", event)},
{_summary(name + "_latest", name + "_orders", order)},
{name} AS (
  SELECT event_id, order_id, courier_id, event_type, event_timestamp, event_date,
         location_lat, location_lon, status_code, notes, pickup_time, delivery_time,
         delivery_duration_hours, is_failed, is_on_time,
         CASE WHEN is_on_time = FALSE OR is_failed THEN {_REASON} END AS late_reason,
         _ingested_at, {RUN_TS} AS _transformed_at
  FROM (SELECT *, delivery_duration_hours <= {sla} AS is_on_time
        FROM (SELECT *, {_HOURS} AS delivery_duration_hours
              FROM {name}_latest LEFT JOIN {name}_orders USING ({order})))
)"""


def _round(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28, 9)), 2) AS DOUBLE)"


_COUNTS = """count(*) AS total_deliveries,
         count(*) FILTER (WHERE event_type = 'delivered') AS delivered_count,
         count(*) FILTER (WHERE is_failed) AS failed_count,
         count(*) FILTER (WHERE is_on_time) AS on_time_count"""
_RATE = _round("avg(CAST(is_on_time AS INTEGER)) * 100.0") + " AS on_time_rate_pct"
_MEAN = _round("avg(delivery_duration_hours)") + " AS avg_duration_hours"
_P95 = _round("quantile_disc(delivery_duration_hours, 0.95)") + " AS p95_duration_hours"


def _kpis(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT courier_id, event_date, {_COUNTS}, {_RATE}, {_MEAN}, {_P95},
         {RUN_TS} AS _aggregated_at
  FROM {source} GROUP BY courier_id, event_date
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join([RAW_SQL.strip(), *parts]) + "\n" + select


def _daily(columns: str) -> str:
    return _with(
        _facts("raw", "facts"),
        select=f"SELECT courier_id, event_date, {columns} FROM facts "
        "GROUP BY courier_id, event_date",
    )


_ALL_FACTS = _with(_facts("raw", "facts"), select="SELECT * FROM facts")
_ALL_KPIS = _with(
    _facts("raw", "facts"), _kpis("facts", "kpis"), select="SELECT * FROM kpis"
)
_ENRICHED = (_latest("raw", "latest"), _summary("latest", "summary"))
_JOINED = "FROM latest LEFT JOIN summary USING (order_id)"
_ALL_RAW = _with(select=f"SELECT {RAW_COLUMNS} FROM raw")

_UPSERTED = _with(
    f"early AS (SELECT * FROM raw WHERE event_timestamp <= {WATERMARK})",
    _facts("early", "known", q.TIGHT_SLA),
    _facts("raw", "facts"),
    f"late AS (SELECT * FROM facts WHERE event_date >= DATE '{q.CHANGE_DAY}')",
    select="SELECT * FROM late UNION ALL SELECT * FROM known "
    "WHERE event_id NOT IN (SELECT event_id FROM late)",
)

_MOVED = _with(
    _facts("raw", "facts"),
    select=f"""SELECT * REPLACE (CASE WHEN event_date IN ({MOVED_DAYS})
        THEN event_date + {q.MOVED_BY} ELSE event_date END AS event_date) FROM facts""",
)

_FIRST = f"event_timestamp <= {WATERMARK} AND notes IS NULL"
_TWO_RUNS = f"""first_mark AS (SELECT max(event_timestamp) AS mark FROM mapped WHERE {_FIRST}),
ingested AS (
  SELECT raw.* REPLACE (CASE WHEN {_FIRST} THEN {WATERMARK} ELSE {RUN_TS} END AS _ingested_at)
  FROM raw, first_mark
  WHERE ({_FIRST}) OR event_timestamp > mark - INTERVAL 3 DAY
)"""


def _touched(days: str) -> str:
    """Facts of every order with an event on the days."""
    return f"""touched AS (
  SELECT * FROM facts
  WHERE order_id IN (SELECT order_id FROM raw WHERE event_date IN ({days}))
)"""


ORACLE: dict[str, str] = {
    "incremental_scan": _with(
        select=f"SELECT {SOURCE_COLUMNS} FROM mapped WHERE event_timestamp > {WATERMARK}"
    ),
    "incremental_scan_overlap": _with(
        select=f"SELECT {SOURCE_COLUMNS} FROM mapped "
        f"WHERE event_timestamp > {WATERMARK} - INTERVAL 3 DAY"
    ),
    "schema_conform": _with(select=f"SELECT {SOURCE_COLUMNS} FROM mapped"),
    "ingest_enrich": _ALL_RAW,
    "raw_date_slice": _with(
        select=f"SELECT {RAW_COLUMNS} FROM raw WHERE event_date = DATE '{q.DAY}'"
    ),
    "facts_date_slice": _with(
        _facts("raw", "facts"),
        select=f"SELECT * FROM facts WHERE event_date = DATE '{q.DAY}'",
    ),
    "dedup_latest": _with(
        _latest("raw", "latest"), select=f"SELECT {RAW_COLUMNS} FROM latest"
    ),
    "order_summary": _with(*_ENRICHED, select="SELECT * FROM summary"),
    "enrich_orders": _with(
        *_ENRICHED,
        select=f"SELECT event_id, order_id, pickup_time, delivery_time, is_failed {_JOINED}",
    ),
    "delivery_duration": _with(
        *_ENRICHED,
        select=f"SELECT event_id, order_id, {_HOURS} AS delivery_duration_hours {_JOINED}",
    ),
    "sla_flag": _with(
        *_ENRICHED,
        select=f"SELECT event_id, order_id, {_HOURS} <= 48.0 AS is_on_time {_JOINED}",
    ),
    "late_reason": _with(
        _facts("raw", "facts"),
        select="SELECT event_id, status_code, is_failed, is_on_time, late_reason FROM facts",
    ),
    "delivery_facts": _ALL_FACTS,
    "delivery_facts_by_date": _with(
        _facts("raw", "facts", by="event_date, "), select="SELECT * FROM facts"
    ),
    "kpi_counts": _daily(_COUNTS),
    "kpi_on_time_rate": _daily(_RATE),
    "kpi_duration_stats": _daily(f"{_MEAN}, {_P95}"),
    "kpi_p95_approximate": _daily(_P95),
    "courier_daily_kpis": _ALL_KPIS,
    "ensure_table": _ALL_KPIS,
    "raw_append": _ALL_RAW,
    "overwrite_partitions": _with(
        _facts("raw", "tight", q.TIGHT_SLA),
        _facts("raw", "facts"),
        _kpis("tight", "before"),
        _kpis("facts", "after"),
        select=f"SELECT * FROM before WHERE event_date < DATE '{q.CHANGE_DAY}' "
        f"UNION ALL SELECT * FROM after WHERE event_date >= DATE '{q.CHANGE_DAY}'",
    ),
    "compact_partitions": _ALL_RAW,
    "compact_small_files": _with(
        select=f"""SELECT {RAW_COLUMNS}, event_date = DATE '{q.DAY}' AS rewritten FROM raw
          UNION ALL SELECT {RAW_COLUMNS}, TRUE FROM raw WHERE event_date = DATE '{q.DAY}'""",
    ),
    "empty_batch_noop": _with(
        select="SELECT count(*) AS raw_rows, CAST(1 AS BIGINT) AS runs FROM mapped"
    ),
    "upsert_facts": _UPSERTED,
    "upsert_idempotent": _UPSERTED,
    "upsert_moved_partition": _MOVED,
    "upsert_by_key_sketch": _MOVED,
    "upsert_composite_key": _with(
        _facts("raw", "tight", q.TIGHT_SLA),
        _facts("raw", "facts"),
        _kpis("tight", "before"),
        _kpis("facts", "after"),
        select=f"SELECT * FROM before WHERE event_date < DATE '{q.CHANGE_DAY}' "
        f"UNION ALL SELECT * FROM after WHERE event_date >= DATE '{q.CHANGE_DAY}'",
    ),
    "upsert_first_load": _ALL_FACTS,
    "upsert_newer_only": _with(
        "once AS (SELECT * FROM raw WHERE notes IS NULL)",
        _facts("once", "stale", q.TIGHT_SLA),
        _facts("raw", "facts"),
        select="""SELECT stale.* FROM stale JOIN facts USING (event_id)
          WHERE stale.event_timestamp >= facts.event_timestamp
          UNION ALL
          SELECT facts.* FROM facts JOIN stale USING (event_id)
          WHERE stale.event_timestamp < facts.event_timestamp""",
    ),
    "watermark_latest": _with(
        select="SELECT max(event_timestamp) AS watermark_ts FROM mapped "
        "WHERE event_type = 'delivered'"
    ),
    "watermark_fallback": _with(
        select=f"SELECT {SOURCE_COLUMNS} FROM mapped "
        f"WHERE event_timestamp > {_ts(q.LATE_RUN_TS)} - INTERVAL 3 DAY"
    ),
    "watermark_update": _with(
        _TWO_RUNS,
        select=f"""SELECT 'ingest_delivery_events' AS job, mark AS watermark_ts,
                 '{q.WATERMARK_TS.date()}' AS run_date FROM first_mark
          UNION ALL
          SELECT 'ingest_delivery_events', max(event_timestamp),
                 '{q.RUN_TS.date()}' FROM mapped""",
    ),
    "ingest_increment": _with(_TWO_RUNS, select=f"SELECT {RAW_COLUMNS} FROM ingested"),
    "transform_one_day": _with(
        _facts("raw", "facts"),
        _touched(f"DATE '{q.DAY}'"),
        select="SELECT * FROM touched",
    ),
    "aggregate_all_days": _ALL_KPIS,
    "backfill_range": _with(
        _facts("raw", "facts"),
        _kpis("facts", "kpis"),
        select=f"SELECT * FROM kpis WHERE event_date IN ({DAYS})",
    ),
    "backfill_range_by_date": _with(
        f"slice AS (SELECT * FROM raw WHERE event_date IN ({DAYS}))",
        _facts("slice", "dated", by="event_date, "),
        """facts AS (
  SELECT * EXCLUDE (run) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_date DESC) AS run
    FROM dated) WHERE run = 1
)""",
        _kpis("facts", "kpis"),
        select="SELECT * FROM kpis",
    ),
    "daily_runs": _with(
        _facts("raw", "facts"),
        _kpis("facts", "kpis"),
        select="SELECT * EXCLUDE (_aggregated_at) FROM kpis",
    ),
    "order_index": _with(
        _TWO_RUNS,
        select="""SELECT DISTINCT event_id AS key, order_id AS other, event_date, 'event' AS side FROM ingested
          UNION ALL SELECT DISTINCT order_id, event_id, CAST(NULL AS DATE), 'order' FROM ingested""",
    ),
    "kpi_signed_deltas": _with(
        f"early AS (SELECT * FROM raw WHERE event_timestamp <= {WATERMARK})",
        _facts("early", "known", q.TIGHT_SLA),
        _facts("raw", "facts"),
        f"late AS (SELECT * FROM facts WHERE event_date >= DATE '{q.CHANGE_DAY}')",
        """two AS (SELECT * FROM late UNION ALL
  SELECT * FROM known WHERE event_id NOT IN (SELECT event_id FROM late))""",
        f"""moved AS (SELECT * REPLACE (event_date + {q.MOVED_BY} AS event_date)
  FROM facts WHERE event_date IN ({MOVED_DAYS}))""",
        """three AS (SELECT * FROM moved UNION ALL
  SELECT * FROM two WHERE event_id NOT IN (SELECT event_id FROM moved))""",
        _kpis("three", "kpis"),
        select="SELECT * FROM kpis",
    ),
    "reconcile_raw": _with(
        f"""whole AS (SELECT raw.* REPLACE (
    CASE WHEN {_FIRST} THEN {WATERMARK} ELSE {RUN_TS} END AS _ingested_at) FROM raw)""",
        select=f"SELECT {RAW_COLUMNS} FROM whole",
    ),
    "kpi_weekly_sketch": _with(
        _facts("raw", "facts"),
        select="""SELECT courier_id, CAST(date_trunc('week', event_date) AS DATE) AS week,
            count(delivery_duration_hours) AS timed, TRUE AS within
          FROM facts WHERE delivery_duration_hours IS NOT NULL GROUP BY ALL""",
    ),
    "quarantine_accepted": _with(
        select=f"""SELECT {SOURCE_COLUMNS} FROM mapped
          WHERE CAST(event_id AS BIGINT) % 97 <> 0 AND CAST(event_id AS BIGINT) % 101 <> 0
            AND CAST(event_id AS BIGINT) % 89 <> 0""",
    ),
    "quarantine_refused": _with(
        select="""SELECT event_id, 'event_timestamp' AS "column", 'malformed' AS reason, 'soon' AS value
          FROM mapped WHERE CAST(event_id AS BIGINT) % 97 = 0
          UNION ALL SELECT event_id, 'location_lat', 'malformed', 'north'
          FROM mapped WHERE CAST(event_id AS BIGINT) % 89 = 0
          UNION ALL SELECT event_id, 'event_type', 'missing', NULL
          FROM mapped WHERE CAST(event_id AS BIGINT) % 101 = 0""",
    ),
    "scan_by_quantile": _with(
        select="SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS parts, TRUE AS balanced FROM mapped"
    ),
}
