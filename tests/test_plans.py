"""Shapes of physical plans that decide how the work spreads over a cluster."""

import re
from datetime import date

import pytest
from fixtures import four_orders

from parcel_engine.operators import courier_daily_kpis, dedup_latest, delivery_facts
from parcel_engine.operators.keys import rows_with_keys
from parcel_engine.plans.transform import History
from parcel_engine.session import session_conf, staging
from parcel_engine.sinks.order_index import OrderIndex

SETTINGS = {
    "spark.sql.maxMetadataStringLength": "10000",
    "spark.sql.debug.maxToStringFields": "1000",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@pytest.fixture
def shuffled(spark):
    """Joins as they are on large inputs, and plans printed in full."""
    with session_conf(spark, SETTINGS):
        yield spark


def raw_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    four_orders(spark).write.parquet(path)
    return spark.read.parquet(path)


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = planned(dedup_latest(four_orders(spark)))
    below = plan[plan.index("Exchange hashpartitioning(event_id") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_summary_scans_narrow_columns(shuffled, tmp_path):
    plan = planned(delivery_facts(raw_files(shuffled, tmp_path)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("notes" in s for s in schemas)
    narrow = [s for s in schemas if "notes" not in s]
    assert narrow and all("location_lat" not in s and "courier_id" not in s for s in narrow)


def test_orders_are_dealt_over_slices_without_broadcast(shuffled, tmp_path):
    plan = executed(delivery_facts(raw_files(shuffled, tmp_path)))
    assert "BroadcastHashJoin" not in plan
    assert re.search(r"SortMergeJoin \[order_id#\d+, _slice#\d+L?\]", plan)
    assert re.search(r"Exchange hashpartitioning\(order_id#\d+, _slice#\d+L?", plan)


def test_kpis_spread_a_courier_day_by_duration(spark):
    plan = planned(courier_daily_kpis(delivery_facts(four_orders(spark))))
    keys = r"courier_id#\d+, event_date#\d+, delivery_duration_hours#\d+, \d"
    assert re.search(rf"Exchange hashpartitioning\({keys}", plan)
    assert "ObjectHashAggregate" not in plan and "Python" not in plan


def test_key_lookup_shuffles_both_sides_for_itself(shuffled, tmp_path):
    raw = raw_files(shuffled, tmp_path)
    keys = raw.select("event_id").distinct()
    found = rows_with_keys(raw, keys, "event_id")
    assert found.columns == raw.columns and found.count() == raw.count()
    plan = planned(dedup_latest(found))
    both = re.findall(r"Exchange hashpartitioning\(event_id#\d+, _part#\d+", plan)
    assert len(both) == 2
    assert "Partial" in plan[: plan.index("SortMergeJoin")]


def test_key_lookup_takes_only_the_keys(spark):
    raw = four_orders(spark)
    keys = raw.filter("event_type = 'failed'").select("order_id").distinct()
    got = {r["event_id"] for r in rows_with_keys(raw, keys, "order_id").collect()}
    assert got == {"evt-006", "evt-007"}


def scans_of(plan: str, column: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


def test_history_reads_raw_of_the_days_found_alone(shuffled, database):
    table = f"{database}.raw"
    four_orders(shuffled, one_day=False).write.partitionBy("event_date").saveAsTable(table)
    raw, index = shuffled.table(table), OrderIndex.build(shuffled, table)
    with staging(shuffled) as stage:
        kept = []
        stage.keep = lambda df, keep=stage.keep: kept.append(planned(df)) or keep(df)
        history = History(raw, [date(2024, 1, 14)], stage, index)
        assert history.days == {date(2024, 1, 14), date(2024, 1, 15)}
        scans = [line for plan in kept for line in plan.splitlines() if "FileScan" in line]
        of_raw = [line for line in scans if "/raw]" in line or "/raw/event_date" in line]
        assert len(of_raw) == 2 and sum("notes" in line for line in of_raw) == 1
        assert all(re.search(r"PartitionFilters: \[[^\]]*event_date", line) for line in of_raw)
        # the index is read by side and bucket
        of_index = [line for line in scans if "order_index" in line]
        assert len(of_index) == 2
        assert all(re.search(r"PartitionFilters: \[[^\]]*side[^\]]*bucket", line) for line in of_index)


def test_a_lookup_reads_the_buckets_of_its_keys(shuffled, database):
    table = f"{database}.raw"
    four_orders(shuffled, one_day=False).write.partitionBy("event_date").saveAsTable(table)
    index = OrderIndex.build(shuffled, table, buckets=8)
    keys = shuffled.createDataFrame([("evt-001",)], "event_id string")
    found = index.lookup("event", keys)
    rows = found.collect()
    assert [(r.key, r.other, str(r.event_date)) for r in rows] == [("evt-001", "order-1", "2024-01-14")]
    assert all("bucket=" in f and "side=event" in f for f in found.inputFiles())
    read = {re.search(r"bucket=(\d+)", f)[1] for f in found.inputFiles() if "side=" in f}
    assert len(read) == 1
