"""Table schemas, and the projection that brings a DataFrame into one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, TIMESTAMP, DATE = StringType(), TimestampType(), DateType()
DOUBLE, BOOLEAN, INT, LONG = DoubleType(), BooleanType(), IntegerType(), LongType()


def _required(**columns) -> list[StructField]:
    return [StructField(name, kind, nullable=False) for name, kind in columns.items()]


def _optional(**columns) -> list[StructField]:
    return [StructField(name, kind, nullable=True) for name, kind in columns.items()]


_IDENTITY = _required(
    event_id=STRING,
    order_id=STRING,
    courier_id=STRING,
    event_type=STRING,
    event_timestamp=TIMESTAMP,
)
_DETAIL = _optional(
    location_lat=DOUBLE, location_lon=DOUBLE, status_code=STRING, notes=STRING
)

# Column names, order and types of the five tables.
SOURCE = StructType(_IDENTITY + _DETAIL)

RAW = StructType(
    _IDENTITY
    + _DETAIL
    + _required(_ingested_at=TIMESTAMP, event_date=DATE, year=INT, month=INT, day=INT)
)

FACT = StructType(
    _IDENTITY
    + _required(event_date=DATE)
    + _DETAIL
    + _optional(
        pickup_time=TIMESTAMP, delivery_time=TIMESTAMP, delivery_duration_hours=DOUBLE
    )
    + _required(is_failed=BOOLEAN)
    + _optional(is_on_time=BOOLEAN, late_reason=STRING)
    + _required(_ingested_at=TIMESTAMP, _transformed_at=TIMESTAMP)
)

KPI = StructType(
    _required(
        courier_id=STRING,
        event_date=DATE,
        total_deliveries=LONG,
        delivered_count=LONG,
        failed_count=LONG,
        on_time_count=LONG,
    )
    + _optional(
        on_time_rate_pct=DOUBLE, avg_duration_hours=DOUBLE, p95_duration_hours=DOUBLE
    )
    + _required(_aggregated_at=TIMESTAMP)
)

WATERMARK = StructType(_required(job=STRING, watermark_ts=TIMESTAMP, run_date=STRING))


def require_columns(df: DataFrame, schema: StructType) -> None:
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast and reorder the columns of ``df`` to ``schema``; extra columns are dropped.

    Casts follow the session's ANSI mode, so a malformed value raises instead of
    turning into a null. A missing column raises here, before any job starts.
    """
    require_columns(df, schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def ddl(schema: StructType) -> str:
    """The schema as a column list, e.g. for the JDBC ``customSchema`` option."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
