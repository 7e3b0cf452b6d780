"""Sinks: append, overwrite, upsert, compaction."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcel_engine.schemas import FACT, KPI, conform
from parcel_engine.sinks import tables
from parcel_engine.sinks.upsert import upsert

ROW = "event_id string, event_date date, seq int, note string"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def content(spark, table):
    rows = spark.table(table).select("event_id", "event_date", "seq", "note").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.fixture
def target(spark, database):
    table = f"{database}.facts"
    base = [("a", D1, 1, "old"), ("b", D1, 1, "old"), ("c", D2, 1, "old"), ("d", D3, 1, "old")]
    upsert(frame(spark, base), table, ["event_id"])
    return table


class TestTables:
    def test_ensure_creates_once(self, spark, database):
        table = f"{database}.kpis"
        assert tables.ensure_table(spark, table, KPI).count() == 0
        assert tables.is_partitioned(spark, table)
        tables.append(
            spark.range(1).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in KPI[:1]],
                F.lit(D1).alias("event_date"),
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in KPI[2:]],
            ),
            table,
        )
        assert tables.ensure_table(spark, table, KPI).count() == 1

    def test_append_matches_columns_by_name(self, spark, database):
        table = f"{database}.t"
        df = frame(spark, [("a", D1, 1, "x")])
        tables.ensure_table(spark, table, df.schema)
        turned = df.select("note", "seq", "event_date", "event_id")
        assert tables.append(turned, table) == {"rows": 1}
        assert content(spark, table) == [("a", D1, 1, "x")]

    def test_empty_append(self, spark, database):
        table = f"{database}.t"
        df = frame(spark, [])
        tables.ensure_table(spark, table, df.schema)
        assert tables.append(df, table)["rows"] == 0
        assert content(spark, table) == []
        assert tables.partitions(spark, table) == set()

    def test_overwrite_leaves_other_days(self, spark, target):
        rows = tables.overwrite_partitions(frame(spark, [("z", D1, 9, "new")]), target)
        assert rows == 1
        assert content(spark, target) == [
            ("c", D2, 1, "old"), ("d", D3, 1, "old"), ("z", D1, 9, "new")
        ]

    def test_overwrite_drops_emptied_days(self, spark, target):
        tables.overwrite_partitions(frame(spark, [("z", D1, 9, "new")]), target, emptied=[D2])
        assert tables.partitions(spark, target) == {D1, D3}
        assert content(spark, target) == [("d", D3, 1, "old"), ("z", D1, 9, "new")]

    def test_settings_are_put_back(self, spark, target):
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key)
        tables.overwrite_partitions(frame(spark, [("z", D1, 9, "new")]), target)
        assert spark.conf.get(key) == before

    def test_compaction_keeps_the_rows(self, spark, target):
        for i in range(5):
            tables.append(frame(spark, [(f"n{i}", D1, i, "x"), (f"m{i}", D2, i, "y")]), target)
        before = content(spark, target)
        files = spark.table(target).filter(F.col("event_date") == D1)
        n_before = len(files.inputFiles())
        assert tables.compact_partitions(spark, target, [D1]) == 7
        assert content(spark, target) == before
        after = spark.table(target).filter(F.col("event_date") == D1).inputFiles()
        assert len(after) == 1 < n_before

    def test_only_days_of_small_files_are_compacted(self, spark, target):
        for i in range(3):
            tables.append(frame(spark, [(f"n{i}", D1, i, "x")]), target)
        before = content(spark, target)
        files = set(spark.table(target).filter(F.col("event_date") != D1).inputFiles())
        assert tables.days_of_small_files(spark, target) == {D1}
        assert tables.days_of_small_files(spark, target, file_bytes=10) == set()
        assert tables.compact_small_files(spark, target, order_by=["note", "event_id"]) == {D1}
        assert content(spark, target) == before
        after = set(spark.table(target).inputFiles())
        assert files < after and len(after) == len(files) + 1
        stored = [r.event_id for r in spark.read.parquet(*(after - files)).collect()]
        assert stored == ["a", "b", "n0", "n1", "n2"]
        assert tables.compact_small_files(spark, target) == set()

    def test_conform(self, spark):
        df = frame(spark, [("a", D1, 1, "x")])
        with pytest.raises(ValueError, match="order_id"):
            conform(df, FACT)


class TestReplaceDays:
    """Whatever fails, every day has all its old or all its new rows."""

    def new(self, spark):
        return frame(spark, [("x", D1, 5, "new"), ("y", D2, 5, "new"), ("z", D2, 6, "new")])

    def test_old_folders_go_last(self, spark, target):
        before = {f.rsplit("/", 1)[0] for f in spark.table(target).inputFiles()}
        assert tables.replace_days(self.new(spark), target) == 3
        after = {f.rsplit("/", 1)[0] for f in spark.table(target).inputFiles()}
        assert len(after) == 3 and len(after & before) == 1  # the day that was not replaced
        root = Path(tables.table_folder(spark, target).removeprefix("file:"))
        assert sorted(p.name for p in root.glob("event_date=*")) == [f"event_date={D3}"]
        assert tables.sweep(spark, target) == []
        # appended rows find the new folder, and a second rewrite removes it
        tables.append(frame(spark, [("w", D2, 7, "later")]), target)
        tables.replace_days(frame(spark, [("v", D2, 8, "last")]), target)
        assert content(spark, target) == [("d", D3, 1, "old"), ("v", D2, 8, "last"), ("x", D1, 5, "new")]

    def test_failed_write(self, spark, target):
        before = content(spark, target)
        broken = F.when(F.col("event_id") == "z", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("note"))
        with pytest.raises(Exception, match="lost"):
            tables.replace_days(self.new(spark).withColumn("note", broken), target)
        assert content(spark, target) == before
        tables.replace_days(self.new(spark), target)
        assert len(content(spark, target)) == 4

    def test_short_write(self, spark, target, monkeypatch):
        before = content(spark, target)
        monkeypatch.setattr(tables, "row_counts", lambda df: {D1: 1, D2: 1})
        with pytest.raises(tables.IncompleteWrite):
            tables.replace_days(self.new(spark), target)
        assert content(spark, target) == before

    @pytest.mark.parametrize("fails_at", [0, 1])
    def test_failed_switch(self, spark, target, monkeypatch, fails_at):
        real, calls = tables._switch, []

        def switch(*args):
            if len(calls) == fails_at:
                raise OSError("catalog is away")
            calls.append(args)
            real(*args)

        monkeypatch.setattr(tables, "_switch", switch)
        with pytest.raises(OSError):
            tables.replace_days(self.new(spark), target)
        spark.catalog.refreshTable(target)
        old = [("a", D1, 1, "old"), ("b", D1, 1, "old")] if fails_at == 0 else [("x", D1, 5, "new")]
        assert content(spark, target) == sorted([*old, ("c", D2, 1, "old"), ("d", D3, 1, "old")])
        monkeypatch.setattr(tables, "_switch", real)
        tables.replace_days(self.new(spark), target)
        assert len(content(spark, target)) == 4
        # what the failed run had written is nobody's now, unless a day was switched to it
        tables.sweep(spark, target)
        assert len(content(spark, target)) == 4

    def test_sweep_keeps_what_is_used(self, spark, target):
        tables.replace_days(self.new(spark), target)
        root = tables.table_folder(spark, target)
        frame(spark, [("q", D1, 1, "left")]).write.parquet(f"{root}/{tables.REWRITTEN}left")
        before = content(spark, target)
        assert tables.sweep(spark, target) == [f"{tables.REWRITTEN}left"]
        assert content(spark, target) == before

    @pytest.mark.parametrize("step", ["replace_days", "drop_partitions"])
    def test_upsert_that_fails_loses_no_row(self, spark, target, monkeypatch, step):
        from parcel_engine.sinks import upsert as module

        source = frame(spark, [("a", D1, 2, "new"), ("d", D1, 2, "moved"), ("e", D3, 2, "new")])

        def fail(*args, **kwargs):
            raise OSError("lost")

        with monkeypatch.context() as patched:
            patched.setattr(module, step, fail)
            with pytest.raises(OSError):
                upsert(source, target, ["event_id"])
        assert {"a", "b", "c", "d"} <= {r[0] for r in content(spark, target)}
        upsert(source, target, ["event_id"])
        assert content(spark, target) == [
            ("a", D1, 2, "new"), ("b", D1, 1, "old"), ("c", D2, 1, "old"), ("d", D1, 2, "moved"), ("e", D3, 2, "new"),
        ]

    def test_writers_in_threads(self, spark, database):
        names = [f"{database}.t{i}" for i in range(2)]
        days = [date(2024, 2, 1 + i) for i in range(8)]
        rows = frame(spark, [(f"{d}-{i}", d, i, "x") for d in days for i in range(5)])
        for name in names:
            tables.ensure_table(spark, name, rows.schema)
        changed = rows.filter(F.col("event_date") < days[4]).withColumn("note", F.lit("y"))
        before = spark.conf.get("spark.sql.parquet.outputTimestampType")

        def work(name):
            tables.append(rows, name)
            for _ in range(3):
                tables.replace_days(changed, name)

        with ThreadPoolExecutor(2) as pool:
            list(pool.map(work, names))
        for name in names:
            found = content(spark, name)
            assert len(found) == 40 and sum(r[3] == "y" for r in found) == 20
        assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before


class TestUpsert:
    def test_update_and_insert(self, spark, target):
        source = frame(spark, [("a", D1, 2, "new"), ("e", D2, 2, "new")])
        done = upsert(source, target, ["event_id"])
        assert done == (2, {D1, D2})
        assert content(spark, target) == [
            ("a", D1, 2, "new"), ("b", D1, 1, "old"), ("c", D2, 1, "old"),
            ("d", D3, 1, "old"), ("e", D2, 2, "new"),
        ]

    def test_twice_is_once(self, spark, target):
        source = frame(spark, [("a", D2, 2, "new"), ("d", D1, 2, "new"), ("e", D1, 2, "new")])
        upsert(source, target, ["event_id"])
        once = content(spark, target)
        upsert(source, target, ["event_id"])
        assert content(spark, target) == once

    def test_moved_row_leaves_its_day(self, spark, target):
        done = upsert(frame(spark, [("d", D1, 2, "moved")]), target, ["event_id"])
        assert done.dates == {D1, D3}
        assert tables.partitions(spark, target) == {D1, D2}
        assert content(spark, target) == [
            ("a", D1, 1, "old"), ("b", D1, 1, "old"), ("c", D2, 1, "old"), ("d", D1, 2, "moved")
        ]

    def test_days_swap(self, spark, target):
        upsert(frame(spark, [("c", D3, 2, "x"), ("d", D2, 2, "x")]), target, ["event_id"])
        assert content(spark, target) == [
            ("a", D1, 1, "old"), ("b", D1, 1, "old"), ("c", D3, 2, "x"), ("d", D2, 2, "x")
        ]

    def test_last_run_wins_unless_ordered(self, spark, target):
        old = frame(spark, [("a", D1, 0, "older"), ("b", D1, 1, "same"), ("f", D1, 0, "first")])
        upsert(old, target, ["event_id"], order_by="seq")
        assert content(spark, target)[:2] == [("a", D1, 1, "old"), ("b", D1, 1, "same")]
        assert ("f", D1, 0, "first") in content(spark, target)
        upsert(old, target, ["event_id"])
        assert content(spark, target)[0] == ("a", D1, 0, "older")

    def test_null_keys_insert(self, spark, target):
        source = frame(spark, [(None, D1, 2, "x"), (None, D1, 2, "y")])
        upsert(source, target, ["event_id"])
        upsert(source, target, ["event_id"])
        assert sum(r[0] is None for r in content(spark, target)) == 4

    def test_composite_key(self, spark, target):
        upsert(
            frame(spark, [("a", D1, 2, "new"), ("a", D2, 2, "other day")]),
            target,
            ["event_id", "event_date"],
        )
        assert content(spark, target) == [
            ("a", D1, 2, "new"), ("a", D2, 2, "other day"), ("b", D1, 1, "old"),
            ("c", D2, 1, "old"), ("d", D3, 1, "old"),
        ]

    def test_null_in_composite_key(self, spark, target):
        keys = ["event_id", "note"]
        source = frame(spark, [("a", D1, 2, None), ("b", D1, 2, "old")])
        upsert(source, target, keys)
        rows = content(spark, target)
        assert ("a", D1, 1, "old") in rows and ("a", D1, 2, None) in rows
        assert ("b", D1, 2, "old") in rows and ("b", D1, 1, "old") not in rows

    def test_repeated_source_key_is_an_error(self, spark, target):
        before = content(spark, target)
        with pytest.raises(ValueError, match="several rows"):
            upsert(frame(spark, [("a", D1, 2, "x"), ("a", D2, 3, "y")]), target, ["event_id"])
        assert content(spark, target) == before

    def test_empty_source(self, spark, target):
        before = content(spark, target)
        assert upsert(frame(spark, []), target, ["event_id"]) == (0, set())
        assert content(spark, target) == before

    def test_source_read_from_the_target(self, spark, target):
        changed = spark.table(target).withColumn("note", F.lit("rewritten"))
        upsert(changed, target, ["event_id"])
        assert {r[3] for r in content(spark, target)} == {"rewritten"}
        assert len(content(spark, target)) == 4

    def test_interrupted_run_is_repaired(self, spark, target):
        moved = frame(spark, [("d", D1, 2, "moved")])
        tables.append(moved, target)  # the state after the append step alone
        assert sum(r[0] == "d" for r in content(spark, target)) == 2
        upsert(moved, target, ["event_id"])
        assert sum(r[0] == "d" for r in content(spark, target)) == 1

    def test_no_staged_tables_remain(self, spark, target):
        before = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
        upsert(frame(spark, [("a", D1, 2, "new")]), target, ["event_id"])
        assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == before
