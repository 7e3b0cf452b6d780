"""Where events and orders are to be found: a narrow table beside the raw one.

Of every event that raw has ever held, the index knows its orders and days, and of every order
its events. Rows lie in ``buckets`` partitions by a hash of their key, once by event and once by
order, so a lookup reads the buckets of its keys alone, and raw is never searched.

The index is built from raw at its first use. From then on each batch is added to the index
before it reaches raw, from the batch alone (``append`` and ``replace_days`` see to that). A run that
fails in between leaves entries without rows, which cost a little work and change no result.
Entries of rows that raw has lost are of the same kind; ``build`` makes the index anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.operators.keys import rows_with_keys
from parcel_engine.sinks.tables import INDEX, insert, properties

BUCKETS = 16
EVENT, ORDER = "event", "order"
_SCHEMA = "key string, other string, event_date date, side string, bucket int"


@dataclass(frozen=True)
class OrderIndex:
    spark: SparkSession
    table: str
    buckets: int

    @classmethod
    def of(cls, spark: SparkSession, raw_table: str) -> OrderIndex | None:
        """The index of a raw table that has one."""
        value = properties(spark, raw_table).get(INDEX)
        if value is None:
            return None
        table, buckets = value.rsplit(":", 1)
        return cls(spark, table, int(buckets))

    @classmethod
    def build(cls, spark: SparkSession, raw_table: str, buckets: int = BUCKETS) -> OrderIndex:
        """A new index of all of raw. Raw refers to it only when it is complete."""
        index = cls(spark, f"{raw_table}_order_index", buckets)
        spark.sql(f"ALTER TABLE {raw_table} UNSET TBLPROPERTIES IF EXISTS ('{INDEX}')")
        spark.sql(f"DROP TABLE IF EXISTS {index.table}")
        empty = spark.createDataFrame([], _SCHEMA).write.format("parquet")
        empty.partitionBy("side", "bucket").saveAsTable(index.table)
        index.extend(spark.table(raw_table))
        spark.sql(f"ALTER TABLE {raw_table} SET TBLPROPERTIES ('{INDEX}' = '{index.table}:{buckets}')")
        return index

    @classmethod
    def ensure(cls, spark: SparkSession, raw_table: str) -> OrderIndex:
        return cls.of(spark, raw_table) or cls.build(spark, raw_table)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def extend(self, rows: DataFrame) -> None:
        """Add raw rows; what copies of them say is added once."""
        places = rows.select("event_id", "order_id", "event_date").distinct()
        event, order, day = F.col("event_id"), F.col("order_id"), F.col("event_date")
        entry = lambda side, *of: F.struct(*(v.alias(n) for n, v in zip(("key", "other", "event_date"), of)), F.lit(side).alias("side"))
        both = F.array(entry(EVENT, event, order, day), entry(ORDER, order, event, F.lit(None).cast("date")))
        entries = places.select(F.inline(both)).filter(F.col("key").isNotNull())
        bucketed = entries.withColumn("bucket", self._bucket("key"))
        insert(bucketed.hint("rebalance", "side", "bucket"), self.table)

    def entries(self, side: str) -> DataFrame:
        """All of one side, each once: (key, other, event_date)."""
        return self.spark.table(self.table).filter(F.col("side") == side).select("key", "other", "event_date").distinct()

    def lookup(self, side: str, keys: DataFrame) -> DataFrame:
        """Entries (key, other, event_date) of the keys, a staged DataFrame of one column.

        The buckets of the keys are collected, at most as many as there are.
        """
        name = keys.columns[0]
        hit = sorted(r[0] for r in keys.select(self._bucket(name)).distinct().collect())
        rows = self.spark.table(self.table).filter((F.col("side") == side) & F.col("bucket").isin(hit))
        return rows_with_keys(rows.select("key", "other", "event_date"), keys.select(F.col(name).alias("key")), "key")

    def orders_of(self, events: DataFrame) -> DataFrame:
        """Distinct ``order_id`` of the events, of any of their versions."""
        found = self.lookup(EVENT, events).select(F.col("other").alias("order_id"))
        return found.filter(F.col("order_id").isNotNull()).distinct()

    def events_of(self, orders: DataFrame) -> DataFrame:
        return self.lookup(ORDER, orders).select(F.col("other").alias("event_id"))

    def days_of(self, events: DataFrame) -> DataFrame:
        """Distinct days that hold a version of the events."""
        return self.lookup(EVENT, events).select("event_date").distinct()
