"""Rows that do not fit a schema go to a side table instead of stopping the job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcel_engine.schemas import require_columns
from parcel_engine.session import Stage, batch_clock
from parcel_engine.sinks.tables import append, ensure_table

#: Fixed reasons.
MALFORMED, MISSING = "malformed", "missing"
QUARANTINE = "row string, problems array<struct<column: string, reason: string, value: string>>, _quarantined_at timestamp"


def checked(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, what is wrong with them (``_problems``), and the row as JSON (``_row``).

    A value that cannot be cast is malformed; a null where the schema wants a value is missing.
    Extra columns are kept in the JSON alone.
    """
    require_columns(df, schema)
    values, problems = [], []
    for f in schema:
        given = F.col(f.name)
        value = given.try_cast(f.dataType)
        problem = lambda reason: F.struct(F.lit(f.name).alias("column"), F.lit(reason).alias("reason"), given.cast("string").alias("value"))  # noqa: E731, B023
        found = F.when(given.isNotNull() & value.isNull(), problem(MALFORMED))
        if not f.nullable:
            found = found.when(given.isNull(), problem(MISSING))
        values.append(value.alias(f.name))
        problems.append(found)
    row = F.to_json(F.struct(*df.columns)).alias("_row")
    return df.select(*values, F.array_compact(F.array(*problems)).alias("_problems"), row)


def accept(
    df: DataFrame, schema: StructType, table: str, stage: Stage, run_ts: datetime | None = None
) -> DataFrame:
    """The rows that fit ``schema``; all others are appended to the table ``table``.

    The input is read once, into a staged table, so accepted and refused rows add up to it.
    """
    spark = df.sparkSession
    rows = stage.keep(checked(df, schema))
    ensure_table(spark, table, spark.createDataFrame([], QUARANTINE).schema, partition_by=None)
    refused = rows.filter(F.size("_problems") > 0)
    append(refused.select(F.col("_row").alias("row"), F.col("_problems").alias("problems"), batch_clock(run_ts).alias("_quarantined_at")), table)
    return rows.filter(F.size("_problems") == 0).select(*schema.fieldNames())
