"""Ingest, transform, aggregate and multi-date runs on small tables."""

from datetime import date, timedelta

import pytest
from fixtures import EVENTS, four_orders, raw_frame, raw_row, utc
from pyspark.sql import functions as F
from test_facts import GOLDEN, facts_by_event

from parcel_engine import watermark
from parcel_engine.operators import courier_daily_kpis
from parcel_engine.plans.aggregate import aggregate
from parcel_engine.plans.daily import Tables, run_daily, run_dates
from parcel_engine.plans.ingest import ingest, touched_dates
from parcel_engine.plans.transform import transform
from parcel_engine.schemas import KPI, RAW, SOURCE, WATERMARK
from parcel_engine.session import session_conf
from parcel_engine.sinks.tables import append, ensure_table, partitions

D13, D14, D15 = date(2024, 1, 13), date(2024, 1, 14), date(2024, 1, 15)
RUN = utc("2024-01-16T05:00:00")


@pytest.fixture
def tables(database):
    return Tables(*[f"{database}.{n}" for n in ("raw", "facts", "kpis", "marks")])


def source_of(raw):
    return raw.select(*SOURCE.fieldNames())


def load(spark, table, rows):
    ensure_table(spark, table, RAW)
    append(rows if hasattr(rows, "columns") else raw_frame(spark, rows), table)


def state(spark, table, *without):
    df = spark.table(table).drop(*without)
    return sorted((tuple(r) for r in df.collect()), key=str)


class TestIngest:
    def test_fallback_then_mark(self, spark, tables):
        source = source_of(four_orders(spark))
        done = ingest(spark, source, tables.raw, tables.watermarks, RUN)
        assert done.rows == 10  # all within three days of the run
        assert done.watermark == utc("2024-01-15T18:00:00")
        assert done.since == RUN - timedelta(days=3)
        raw = spark.table(tables.raw)
        assert set(raw.columns) == set(RAW.fieldNames())
        assert raw.filter("day(event_date) <> day or year <> 2024 or month <> 1").count() == 0
        assert touched_dates(spark, tables.raw, done) == {D13, D14, D15}
        log = spark.table(tables.watermarks).collect()
        assert [(r["job"], r["run_date"]) for r in log] == [(watermark.JOB, "2024-01-16")]

    def test_fallback_bound_is_strict(self, spark, tables):
        source = source_of(four_orders(spark))
        done = ingest(
            spark, source, tables.raw, tables.watermarks, RUN, lookback=timedelta(hours=20)
        )
        # from 2024-01-15 09:00, exclusive: the failed event at 09:00 is not read
        got = {r[0] for r in spark.table(tables.raw).select("event_id").collect()}
        assert got == {"evt-005", "evt-008", "evt-009"} and done.rows == 3

    def test_empty_batch_changes_nothing(self, spark, tables):
        source = source_of(four_orders(spark))
        first = ingest(spark, source.filter("false"), tables.raw, tables.watermarks, RUN)
        assert first.rows == 0 and touched_dates(spark, tables.raw, first) == set()
        assert not spark.catalog.tableExists(tables.watermarks)
        ingest(spark, source, tables.raw, tables.watermarks, RUN)
        again = ingest(
            spark, source, tables.raw, tables.watermarks, RUN, overlap=timedelta(0)
        )
        assert again.rows == 0
        assert spark.table(tables.raw).count() == 10
        assert spark.table(tables.watermarks).count() == 1

    def test_overlap_picks_up_late_rows(self, spark, tables):
        early = [e for e in EVENTS if e[0] != "evt-003"]
        rows = raw_frame(spark, [raw_row(*e) for e in early])
        ingest(spark, source_of(rows), tables.raw, tables.watermarks, RUN)
        everything = source_of(four_orders(spark))
        strict = ingest(
            spark, everything, tables.raw, tables.watermarks, RUN, overlap=timedelta(0)
        )
        assert strict.rows == 0
        ingest(spark, everything, tables.raw, tables.watermarks, RUN)
        assert spark.table(tables.raw).filter("event_id = 'evt-003'").count() == 1
        assert spark.table(tables.raw).count() == 10

    def test_equal_rows_of_a_batch_and_corrections_stay(self, spark, tables):
        source = source_of(four_orders(spark))
        twice = source.unionByName(source)
        assert ingest(spark, twice, tables.raw, tables.watermarks, RUN).rows == 20
        assert ingest(spark, twice, tables.raw, tables.watermarks, RUN).rows == 0
        changed = source.withColumn("status_code", F.lit("AI002"))
        assert ingest(spark, changed, tables.raw, tables.watermarks, RUN).rows == 10

    def test_future_row_does_not_move_the_mark_past_the_run(self, spark, tables):
        rows = [raw_row(*e) for e in EVENTS]
        rows.append(raw_row("evt-x", "order-9", "courier-A", "pickup", "2031-01-01T00:00:00"))
        done = ingest(
            spark, source_of(raw_frame(spark, rows)), tables.raw, tables.watermarks, RUN
        )
        assert done.watermark == RUN

    def test_mark_never_moves_back(self, spark, tables):
        source = source_of(four_orders(spark))
        ingest(spark, source, tables.raw, tables.watermarks, RUN)
        old = source.filter("event_id = 'evt-009'")
        done = ingest(spark, old, tables.raw, tables.watermarks, RUN + timedelta(days=1))
        assert done.watermark == utc("2024-01-15T18:00:00")

    def test_zoneless_source(self, spark, tables):
        source = source_of(four_orders(spark)).withColumn(
            "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")
        )
        done = ingest(spark, source, tables.raw, tables.watermarks, RUN)
        assert done.rows == 10 and done.watermark == utc("2024-01-15T18:00:00")

    def test_session_must_be_utc(self, spark, tables):
        with session_conf(spark, {"spark.sql.session.timeZone": "Europe/Rome"}):
            with pytest.raises(ValueError, match="UTC"):
                ingest(spark, four_orders(spark), tables.raw, tables.watermarks, RUN)


class TestWatermark:
    def test_latest_of_the_job(self, spark, database):
        table = f"{database}.log"
        watermark.advance(spark, table, utc("2024-01-02T00:00:00.123456"), "2024-01-02", "a")
        watermark.advance(spark, table, utc("2024-01-01T00:00:00"), "2024-01-01", "a")
        watermark.advance(spark, table, utc("2024-01-09T00:00:00"), "2024-01-09", "b")
        assert spark.table(table).schema["watermark_ts"].dataType == WATERMARK[1].dataType
        got = watermark.current(spark, table, RUN, job="a")
        assert got == (utc("2024-01-02T00:00:00.123456"), True)
        assert watermark.current(spark, table, RUN, job="c") == (RUN - timedelta(days=3), False)

    def test_missing_log(self, spark, database):
        got = watermark.current(spark, f"{database}.none", RUN, timedelta(days=1))
        assert got == (RUN - timedelta(days=1), False)

    def test_broken_log_is_raised(self, spark, database):
        spark.range(1).write.saveAsTable(f"{database}.log")
        with pytest.raises(Exception, match="job"):
            watermark.current(spark, f"{database}.log", RUN)


class TestTransform:
    def test_history_of_one_day(self, spark, tables):
        load(spark, tables.raw, four_orders(spark, one_day=False))
        done = transform(spark, tables.raw, tables.facts, [D15], run_ts=RUN)
        assert done == (9, {D13, D14, D15})
        assert facts_by_event(spark.table(tables.facts)) == GOLDEN

    def test_date_scope_of_one_day(self, spark, tables):
        load(spark, tables.raw, four_orders(spark, one_day=False))
        done = transform(spark, tables.raw, tables.facts, ["2024-01-15"], scope="date")
        assert done == (6, {D15})
        hours = spark.table(tables.facts).select(F.max("delivery_duration_hours")).first()
        assert hours[0] is None

    def test_unknown_scope(self, spark, tables):
        load(spark, tables.raw, four_orders(spark))
        with pytest.raises(ValueError, match="scope"):
            transform(spark, tables.raw, tables.facts, [D15], scope="week")

    def test_malformed_date(self, spark, tables):
        load(spark, tables.raw, four_orders(spark))
        with pytest.raises(ValueError):
            transform(spark, tables.raw, tables.facts, ["2024-13-01"])

    def test_empty_day(self, spark, tables):
        load(spark, tables.raw, four_orders(spark))
        assert transform(spark, tables.raw, tables.facts, ["2020-01-01"]) == (0, set())

    def test_late_delivery_changes_earlier_days(self, spark, tables):
        raw = four_orders(spark, one_day=False)
        late = F.col("event_id") == "evt-003"
        load(spark, tables.raw, raw.filter(~late))
        transform(spark, tables.raw, tables.facts)
        before = facts_by_event(spark.table(tables.facts))
        assert before["evt-001"][2] is None
        append(raw.filter(late), tables.raw)
        done = transform(spark, tables.raw, tables.facts, [D15])
        assert D14 in done.dates
        assert facts_by_event(spark.table(tables.facts)) == GOLDEN

    def test_copy_on_the_next_day_moves_the_fact(self, spark, tables):
        rows = [
            raw_row("e1", "o", "c", "pickup", "2024-01-14T23:58:00"),
            raw_row("e1", "o", "c", "pickup", "2024-01-15T00:03:00"),
            raw_row("e2", "o", "c", "delivered", "2024-01-14T23:59:00"),
        ]
        load(spark, tables.raw, rows)
        for days in ([D14], [D15], [D15, D14]):
            transform(spark, tables.raw, tables.facts, days)
            got = {r["event_id"]: r["event_date"] for r in spark.table(tables.facts).collect()}
            assert got == {"e1": D15, "e2": D14}, days

    def test_event_corrected_to_another_order(self, spark, tables):
        rows = [
            raw_row("p1", "o1", "c", "pickup", "2024-01-13T01:00:00"),
            raw_row("p2", "o2", "c", "pickup", "2024-01-13T02:00:00"),
            raw_row("d", "o1", "c", "delivered", "2024-01-14T01:00:00"),
        ]
        load(spark, tables.raw, rows)
        transform(spark, tables.raw, tables.facts, [D13, D14])
        assert facts_by_event(spark.table(tables.facts))["p1"][2] == 24.0
        moved = raw_row("d", "o2", "c", "delivered", "2024-01-15T02:00:00")
        append(raw_frame(spark, [moved]), tables.raw)
        transform(spark, tables.raw, tables.facts, [D15])
        got = facts_by_event(spark.table(tables.facts))
        assert got["p1"][2] is None  # the old order lost its delivery
        assert got["p2"][2] == got["d"][2] == 48.0
        # A rerun of the first day, which knows order o1 only, must not take it back.
        transform(spark, tables.raw, tables.facts, [D13])
        assert facts_by_event(spark.table(tables.facts)) == got
        assert spark.table(tables.facts).count() == 3

    def test_copies_in_raw_do_not_matter(self, spark, tables):
        raw = four_orders(spark, one_day=False)
        load(spark, tables.raw, raw.unionByName(raw).unionByName(raw))
        transform(spark, tables.raw, tables.facts, [D13, D14, D15])
        assert facts_by_event(spark.table(tables.facts)) == GOLDEN

    def test_newer_only(self, spark, tables):
        load(spark, tables.raw, [raw_row("e", "o", "c", "pickup", "2024-01-15T09:00:00")])
        transform(spark, tables.raw, tables.facts)
        other = tables.raw + "_older"
        load(spark, other, [raw_row("e", "o", "c", "failed", "2024-01-15T08:00:00")])
        transform(spark, other, tables.facts, order_by="event_timestamp")
        assert spark.table(tables.facts).first()["event_type"] == "pickup"
        transform(spark, other, tables.facts)
        assert spark.table(tables.facts).first()["event_type"] == "failed"


class TestAggregate:
    def test_rows_and_sums(self, spark, tables):
        load(spark, tables.raw, four_orders(spark, one_day=False))
        transform(spark, tables.raw, tables.facts)
        n = aggregate(spark, tables.facts, tables.kpis, run_ts=RUN)
        kpis = spark.table(tables.kpis)
        assert n == kpis.count() == 6
        assert kpis.select(F.sum("total_deliveries")).first()[0] == 9
        wanted = courier_daily_kpis(spark.table(tables.facts), RUN)
        assert kpis.select(*KPI.fieldNames()).exceptAll(wanted).isEmpty()

    def test_only_the_given_days(self, spark, tables):
        load(spark, tables.raw, four_orders(spark, one_day=False))
        transform(spark, tables.raw, tables.facts)
        assert aggregate(spark, tables.facts, tables.kpis, [D13]) == 1
        assert partitions(spark, tables.kpis) == {D13}
        aggregate(spark, tables.facts, tables.kpis, [D15])
        assert partitions(spark, tables.kpis) == {D13, D15}

    def test_day_without_facts_loses_its_kpis(self, spark, tables):
        load(spark, tables.raw, [raw_row("e", "o", "c", "pickup", "2024-01-14T23:58:00")])
        run_dates(spark, tables, [D14], RUN)
        assert partitions(spark, tables.kpis) == {D14}
        append(
            raw_frame(spark, [raw_row("e", "o", "c", "pickup", "2024-01-15T00:03:00")]),
            tables.raw,
        )
        done = run_dates(spark, tables, [D15], RUN)
        assert done.dates == {D14, D15}
        assert partitions(spark, tables.kpis) == {D15}
        assert partitions(spark, tables.facts) == {D15}


class TestRuns:
    @pytest.mark.parametrize("scope", ["history", "date"])
    def test_range_equals_day_by_day(self, spark, tables, scope):
        rows = [raw_row(*e) for e in EVENTS]
        rows += [
            raw_row("evt-004", "order-2", "courier-B", "pickup", "2024-01-14T06:00:00"),
            raw_row("evt-010", "order-5", "courier-E", "pickup", "2024-01-13T10:00:00"),
            raw_row("evt-011", "order-5", "courier-E", "delivered", "2024-01-14T10:00:00"),
        ]
        load(spark, tables.raw, rows)
        apart = Tables(tables.raw, tables.facts + "_2", tables.kpis + "_2", tables.watermarks)
        run_dates(spark, tables, [D13, D14, D15], RUN, scope=scope)
        for day in (D13, D14, D15):
            run_dates(spark, apart, [day], RUN, scope=scope)
        assert state(spark, tables.facts) == state(spark, apart.facts)
        assert state(spark, tables.kpis) == state(spark, apart.kpis)

    def test_rerun_changes_nothing(self, spark, tables):
        load(spark, tables.raw, four_orders(spark, one_day=False))
        run_dates(spark, tables, [D14, D15], RUN)
        before = state(spark, tables.facts), state(spark, tables.kpis)
        run_dates(spark, tables, [D14, D15], RUN)
        assert (state(spark, tables.facts), state(spark, tables.kpis)) == before

    def test_no_dates(self, spark, tables):
        assert run_dates(spark, tables, []) == (0, 0, set())

    def test_daily_and_its_retry(self, spark, tables):
        source = source_of(four_orders(spark))
        done = run_daily(spark, source, tables, RUN)
        assert (done.facts, done.kpis) == (9, 6)
        before = state(spark, tables.facts), state(spark, tables.kpis)
        # As if the first attempt had died before it logged its watermark.
        spark.sql(f"DROP TABLE {tables.watermarks}")
        run_daily(spark, source, tables, RUN)
        assert spark.table(tables.raw).count() == 10
        assert (state(spark, tables.facts), state(spark, tables.kpis)) == before

    def test_run_that_stopped_after_ingest_is_made_up_for(self, spark, tables):
        source = source_of(four_orders(spark))
        ingest(spark, source, tables.raw, tables.watermarks, RUN)
        run_daily(spark, source, tables, RUN)
        assert facts_by_event(spark.table(tables.facts)) == GOLDEN

    def test_nothing_new(self, spark, tables):
        source = source_of(four_orders(spark))
        run_daily(spark, source, tables, RUN)
        before = state(spark, tables.facts), state(spark, tables.kpis)
        run_daily(spark, source, tables, RUN, ingest_options={"overlap": timedelta(0)})
        assert (state(spark, tables.facts), state(spark, tables.kpis)) == before
