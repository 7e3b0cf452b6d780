"""Run queries in Spark and their SQL in DuckDB, and compare rows regardless of order.

Usage: python tests/oracle_check.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str | None:
    """None if equal, else what differs."""
    got = entry.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = Counter(tuple(r) for r in got.select(*columns).collect())
    want = connection.sql(entry.oracle_sql()[name])
    if sorted(want.columns) != columns:
        return f"columns {columns} != {sorted(want.columns)}"
    names = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(connection.sql(f"SELECT {names} FROM want").fetchall())
    if rows != expected:
        extra, missing = rows - expected, expected - rows
        return (
            f"{rows.total()} rows, {expected.total()} expected; "
            f"extra {list(extra)[:2]}, missing {list(missing)[:2]}"
        )
    if not rows:
        return "empty"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, *names = sys.argv[1:]
    connection = connect(sf_dir)
    failed = 0
    for name in names or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
