"""Scans, their options, settings and the command line."""

import json
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from fixtures import four_orders, utc

from parcel_engine.__main__ import parse
from parcel_engine.schemas import RAW, SOURCE, ddl
from parcel_engine.session import shared_root
from parcel_engine.settings import load_settings
from parcel_engine.sinks.tables import append, ensure_table
from parcel_engine.sources import jdbc
from parcel_engine.sources.tables import as_date, date_slice, incremental_scan


class Reader:
    """Stands in for ``spark.read`` and keeps what it was asked for; opens no database."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen["options"] = options
        return self

    def load(self):
        return self.seen

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "options": properties}


@pytest.fixture
def fake():
    return SimpleNamespace(read=Reader())


class TestJdbc:
    URL = "jdbc:postgresql://host/db"

    def test_plain(self, fake):
        seen = jdbc.jdbc_scan(fake, self.URL, "delivery_events", user="u", password="p")
        assert seen["format"] == "jdbc"
        assert seen["options"] == {
            "url": self.URL,
            "dbtable": "delivery_events",
            "fetchsize": "10000",
            "customSchema": ddl(SOURCE),
            "user": "u",
            "password": "p",
        }

    def test_ranges(self, fake):
        seen = jdbc.jdbc_partitioned_scan(
            fake, self.URL, "t", utc("2024-01-01T00:00:00"), utc("2024-01-02T00:00:00")
        )
        options = seen["options"]
        assert options["partitionColumn"] == "event_timestamp"
        assert options["lowerBound"] == "2024-01-01 00:00:00"
        assert options["upperBound"] == "2024-01-02 00:00:00"
        assert options["numPartitions"] == "8"

    def test_bad_ranges(self):
        with pytest.raises(ValueError):
            jdbc.range_options(5, 5, "id")
        with pytest.raises(ValueError):
            jdbc.range_options(1, 5, "id", num_partitions=0)

    def test_predicates(self, fake):
        parts = [f"mod(hash(event_id), 4) = {i}" for i in range(4)]
        seen = jdbc.jdbc_predicate_scan(fake, self.URL, "t", parts, fetch_size=5)
        assert seen["predicates"] == parts and seen["table"] == "t"
        assert seen["options"]["fetchsize"] == "5" and "url" not in seen["options"]

    def test_schema_as_columns(self):
        assert ddl(SOURCE).startswith("event_id string, order_id string")
        assert "event_timestamp timestamp" in ddl(SOURCE)


class TestSlices:
    def plan(self, df):
        return df._jdf.queryExecution().executedPlan().toString()

    def test_incremental_is_strict(self, spark):
        got = incremental_scan(four_orders(spark), utc("2024-01-15T09:00:00"))
        assert {r["event_id"] for r in got.collect()} == {"evt-005", "evt-008", "evt-009"}
        wider = incremental_scan(
            four_orders(spark), utc("2024-01-15T09:00:00"), timedelta(hours=1, seconds=1)
        )
        assert wider.count() == 5

    def test_incremental_prunes_and_pushes(self, spark, database):
        table = f"{database}.raw"
        ensure_table(spark, table, RAW)
        append(four_orders(spark, one_day=False), table)
        plan = self.plan(incremental_scan(spark.table(table), utc("2024-01-15T09:00:00")))
        assert "PartitionFilters: [isnotnull(event_date" in plan
        assert "GreaterThan(event_timestamp" in plan

    def test_day_slice_prunes(self, spark, database):
        table = f"{database}.raw"
        ensure_table(spark, table, RAW)
        append(four_orders(spark, one_day=False), table)
        one = date_slice(spark.table(table), "2024-01-14")
        assert one.count() == 2
        assert "PartitionFilters: [isnotnull(event_date" in self.plan(one)
        assert "SelectedPartitions" not in self.plan(one) or len(one.inputFiles()) >= 1
        assert date_slice(spark.table(table), [date(2024, 1, 13), "2024-01-14"]).count() == 3
        assert date_slice(spark.table(table), []).count() == 0

    def test_dates(self):
        assert as_date("2024-02-29") == date(2024, 2, 29)
        for bad in ("2023-02-29", "15/01/2024", datetime(2024, 1, 1)):
            with pytest.raises(ValueError):
                as_date(bad)


class TestSettings:
    def test_defaults(self):
        settings = load_settings(None)
        assert settings.sla_hours == 48.0 and settings.lookback == timedelta(days=3)
        assert settings.late_reasons["no_pickup"] == ["NP001", "NP002"]

    def test_file(self, tmp_path):
        path = tmp_path / "run.json"
        path.write_text(
            json.dumps(
                {
                    "pipeline": {"sla_hours": 24, "lookback_days": 1, "overlap_days": 0},
                    "jdbc": {"num_partitions": 4},
                    "tables": {"raw": "db.raw"},
                }
            )
        )
        settings = load_settings(str(path))
        assert settings.sla_hours == 24.0
        assert (settings.lookback, settings.overlap) == (timedelta(days=1), timedelta(0))
        assert settings.num_partitions == 4 and settings.tables.raw == "db.raw"

    def test_arguments(self):
        args = parse(["run", "--date", "2024-01-15", "--date", "2024-01-16"])
        assert args.job == "run" and args.date == ["2024-01-15", "2024-01-16"]
        assert parse(["sweep"]).date == []
        with pytest.raises(SystemExit):
            parse(["drop", "--date", "2024-01-15"])


class TestSharedFolder:
    def conf(self, values, master):
        conf = SimpleNamespace(get=values.get, set=values.__setitem__)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    def test_named_by_the_session(self):
        session = self.conf({"spark.checkpoint.dir": "hdfs://x/y/"}, "yarn")
        assert shared_root(session) == "hdfs://x/y"

    def test_cluster_without_one(self):
        session = self.conf({"spark.sql.warehouse.dir": "hdfs://x/warehouse"}, "yarn")
        assert shared_root(session) == "hdfs://x/warehouse"

    def test_local_files_serve_local_mode_alone(self):
        for folder in ("file:/tmp/warehouse", "/tmp/warehouse"):
            assert shared_root(self.conf({"spark.sql.warehouse.dir": folder}, "local[4]")) == folder
            for master in ("yarn", "spark://x:7077", "local-cluster[3,2,1024]"):
                with pytest.raises(ValueError, match="checkpoint"):
                    shared_root(self.conf({"spark.sql.warehouse.dir": folder}, master))
