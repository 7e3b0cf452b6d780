"""Delivery-event analytics on Spark DataFrames.

``functions``  column expressions: duration, on-time flag, late reason, rounding
``operators``  DataFrame -> DataFrame steps: dedup, order summary, facts, KPIs
``sources``    JDBC scans, incremental and per-day slices of tables
``sinks``      partitioned Parquet tables: append, overwrite, upsert, compaction
``plans``      the three jobs (ingest, transform, aggregate) and the multi-date run
``workload``   the registered queries over the test tables, with their SQL
"""
