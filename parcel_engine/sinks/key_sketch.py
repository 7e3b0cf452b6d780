"""Which days of a table may hold a key: a Bloom filter of its keys for each day.

The filters are a table of words of 64 bits: (event_date, word, bits). A key sets ``HASHES`` bits in the
filter of its day. Days of which a key finds all its bits may hold it; days without are not read by
an upsert that does not know the days of its matches. A filter that is too small, or that still has
keys which left their day, names days in vain, which costs work and changes no result.

The size is set for the table: some ten bits for each key of a large day. Filters are extended by
each batch before it reaches the table, as the order index is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.sinks.tables import PARTITION, SKETCH, insert, properties

BITS = 20
HASHES = 3


@dataclass(frozen=True)
class KeySketch:
    spark: SparkSession
    table: str
    bits: int  #: log2 of a filter's size
    keys: tuple[str, ...]

    @classmethod
    def of(cls, spark: SparkSession, table: str) -> KeySketch | None:
        """The filters of a table that has some."""
        value = properties(spark, table).get(SKETCH)
        if value is None:
            return None
        name, bits, keys = value.split(":")
        return cls(spark, name, int(bits), tuple(keys.split(",")))

    @classmethod
    def build(cls, spark: SparkSession, table: str, keys: Sequence[str], bits: int = BITS) -> KeySketch:
        """New filters of all rows. The table refers to them only when they are complete."""
        sketch = cls(spark, f"{table}_key_sketch", bits, tuple(keys))
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SKETCH}')")
        spark.sql(f"DROP TABLE IF EXISTS {sketch.table}")
        empty = spark.createDataFrame([], f"word long, bits long, {PARTITION} date").write.format("parquet")
        empty.partitionBy(PARTITION).saveAsTable(sketch.table)
        sketch.extend(spark.table(table))
        value = f"{sketch.table}:{bits}:{','.join(keys)}"
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SKETCH}' = '{value}')")
        return sketch

    def _marks(self, rows: DataFrame, *columns: str) -> DataFrame:
        """The bits of each complete key: ``word`` and ``mask``, with its hash and the number of the bit."""
        known = rows.dropna(subset=list(self.keys)).select(*columns, F.xxhash64(*self.keys).alias("key"))
        size = F.lit((1 << self.bits) - 1)
        places = F.array(*[F.xxhash64("key", F.lit(i)).bitwiseAND(size) for i in range(HASHES)])
        marks = known.select(*columns, "key", F.posexplode(places).alias("i", "place"))
        mask = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
        return marks.select(*columns, "key", "i", F.expr("shiftright(place, 6)").alias("word"), mask.alias("mask"))

    def extend(self, rows: DataFrame) -> None:
        """Add the keys of rows; combined before the shuffle, so a filter's size bounds what is sent."""
        words = self._marks(rows, PARTITION).groupBy(PARTITION, "word").agg(F.bit_or("mask").alias("bits"))
        insert(words.hint("rebalance", PARTITION), self.table)

    def days_of(self, rows: DataFrame) -> set[date]:
        """Days that may hold a key of the rows; every day that does hold one is among them."""
        marks = self._marks(rows).distinct()
        hits = self.spark.table(self.table).join(marks, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) != 0)
        found = hits.groupBy(PARTITION, "key").agg(F.count_distinct("i").alias("n")).filter(F.col("n") == HASHES)
        return {r[0] for r in found.select(PARTITION).distinct().collect()}
