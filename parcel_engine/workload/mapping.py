"""The test data's ``events`` table as delivery events, in Spark and in SQL.

Orders are a user's events within three days, couriers are users modulo 25. The source
delivers some events twice: every failed one again five minutes later, and every page view
again with the same event time but ingested an hour later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.schemas import SOURCE
from parcel_engine.sources.tables import enrich_calendar

# Fixed values of the mapping: event types, and twelve status codes of which the tenth is
# in no rule and the last two are missing.
EVENT_TYPES = {"signup": "pickup", "purchase": "delivered", "error": "failed"}
OTHER_TYPE = "in-transit"
STATUS_CODES = [
    "NP001", "NP002", "CD001", "CD002", "CD003", "AI001", "AI002", "AI003", "AI004", "ZZ999",
]
EPOCH = "2024-01-01"


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine source columns, every delivery of an event once; times stay without zone.

    A tenth column, ``_delay_hours``, says how long after the event it was ingested.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.lit(OTHER_TYPE)
    for name, target in EVENT_TYPES.items():
        kind = F.when(F.col("event_type") == name, F.lit(target)).otherwise(kind)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 12
    codes = F.array(*[F.lit(c) for c in STATUS_CODES])
    slot = F.floor(F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date")) / 3)
    user = F.col("user_id").cast("string")
    once = F.struct(F.lit(0).alias("minutes"), F.lit(1).alias("delay"))
    resent = F.struct(F.lit(5).alias("minutes"), F.lit(1).alias("delay"))
    reingested = F.struct(F.lit(0).alias("minutes"), F.lit(2).alias("delay"))
    deliveries = (
        F.when(F.col("event_type") == "error", F.array(once, resent))
        .when(F.col("event_type") == "view", F.array(once, reingested))
        .otherwise(F.array(once))
    )
    copies = events.select("*", F.posexplode(deliveries).alias("copy", "sent"))
    return copies.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws("-", user, slot.cast("string")).alias("order_id"),
        F.concat(F.lit("c"), (F.col("user_id") % 25).cast("string")).alias("courier_id"),
        kind.alias("event_type"),
        F.expr("ts + make_dt_interval(0, 0, sent.minutes, 0)").alias("event_timestamp"),
        (F.col("value") / 10).alias("location_lat"),
        F.lit(None).cast("double").alias("location_lon"),
        F.get(codes, k).alias("status_code"),
        F.when(F.col("copy") > 0, F.lit("resend")).alias("notes"),
        F.col("sent.delay").alias("_delay_hours"),
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the nine source columns."""
    return source_events(spark, sf_dir).select(*SOURCE.fieldNames())


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table's columns; the time of ingest follows the event time."""
    ingested = F.expr("event_timestamp + make_dt_interval(0, _delay_hours, 0, 0)")
    return enrich_calendar(source_events(spark, sf_dir), ingested).drop("_delay_hours")


def _case(pairs: list[tuple], subject: str, other: str = "NULL") -> str:
    branches = " ".join(f"WHEN {subject} = {key} THEN '{value}'" for key, value in pairs)
    return f"CASE {branches} ELSE {other} END"


_SQL_TYPE = _case(
    [(f"'{a}'", b) for a, b in EVENT_TYPES.items()], "event_type", f"'{OTHER_TYPE}'"
)
_SQL_CODE = _case(list(enumerate(STATUS_CODES)), "k % 12")

# Common table expressions for the same rows in SQL; ``raw`` is the last of them.
RAW_SQL = f"""
deliveries AS (
  SELECT *, 0 AS copy, 0 AS minutes, 1 AS delay FROM events
  UNION ALL SELECT *, 1, 5, 1 FROM events WHERE event_type = 'error'
  UNION ALL SELECT *, 1, 0, 2 FROM events WHERE event_type = 'view'
),
coded AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM deliveries
),
mapped AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) || '-' ||
           CAST(date_diff('day', DATE '{EPOCH}', CAST(ts AS DATE)) // 3 AS VARCHAR) AS order_id,
         'c' || CAST(user_id % 25 AS VARCHAR) AS courier_id,
         {_SQL_TYPE} AS event_type,
         ts + to_minutes(minutes) AS event_timestamp,
         value / 10 AS location_lat,
         CAST(NULL AS DOUBLE) AS location_lon,
         {_SQL_CODE} AS status_code,
         CASE WHEN copy > 0 THEN 'resend' END AS notes,
         ts + to_minutes(minutes) + to_hours(delay) AS _ingested_at
  FROM coded
),
raw AS (
  SELECT *, CAST(event_timestamp AS DATE) AS event_date,
         CAST(year(event_timestamp) AS INTEGER) AS year,
         CAST(month(event_timestamp) AS INTEGER) AS month,
         CAST(day(event_timestamp) AS INTEGER) AS day
  FROM mapped
)"""
