"""Order index, signed KPI deltas, reconciliation, sketches, quarantine and cuts."""

from datetime import date, timedelta

import pytest
from fixtures import EVENTS, four_orders, raw_frame, raw_row, utc
from pyspark.sql import functions as F

from parcel_engine import watermark
from parcel_engine.operators import courier_daily_kpis, delivery_facts
from parcel_engine.operators.sketches import RANK_ERROR, duration_sketches, merged_sketches, sketched_quantile
from parcel_engine.plans import deltas
from parcel_engine.plans.ingest import ingest
from parcel_engine.plans.reconcile import reconcile
from parcel_engine.plans.transform import transform
from parcel_engine.schemas import FACT, KPI, RAW, SOURCE, conform
from parcel_engine.session import staging
from parcel_engine.sinks import upsert as module
from parcel_engine.sinks.key_sketch import KeySketch
from parcel_engine.sinks.order_index import OrderIndex
from parcel_engine.sinks.quarantine import accept
from parcel_engine.sinks.tables import append, compact_partitions, ensure_table, overwrite_partitions
from parcel_engine.sinks.upsert import upsert
from parcel_engine.sources.cuts import cut_predicates, quantile_cuts

D13, D14, D15 = date(2024, 1, 13), date(2024, 1, 14), date(2024, 1, 15)
RUN = utc("2024-01-16T05:00:00")


def state(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def raw(spark, database):
    table = f"{database}.raw"
    ensure_table(spark, table, RAW)
    append(four_orders(spark, one_day=False), table)
    return table


class TestOrderIndex:
    def places(self, spark, raw):
        return state(spark.table(raw).select("event_id", "order_id", "event_date").distinct())

    def test_follows_raw(self, spark, raw):
        assert OrderIndex.of(spark, raw) is None
        index = OrderIndex.ensure(spark, raw)
        assert OrderIndex.ensure(spark, raw) == index
        assert state(index.entries("event")) == self.places(spark, raw)
        late = raw_frame(spark, [raw_row("evt-001", "order-9", "c", "pickup", "2024-01-16T01:00:00"), raw_row("evt-020", "order-1", "c", "pickup", "2024-01-13T01:00:00")])
        append(late, raw)
        assert state(index.entries("event")) == self.places(spark, raw)
        assert {r[0] for r in state(index.entries("order"))} == {f"order-{k}" for k in (1, 2, 3, 4, 9)}
        moved = spark.table(raw).filter(F.col("event_date") == D13).withColumn("order_id", F.lit("order-7"))
        overwrite_partitions(moved, raw)
        assert set(self.places(spark, raw)) <= set(state(index.entries("event")))
        before = index.spark.table(index.table).count()
        compact_partitions(spark, raw, [D13, D15])
        assert index.spark.table(index.table).count() == before

    def test_entries_without_rows_change_nothing(self, spark, raw, database):
        index = OrderIndex.build(spark, raw)
        # a batch that entered the index and then failed to reach raw
        index.extend(raw_frame(spark, [raw_row("evt-008", "order-1", "c", "pickup", "2024-01-12T01:00:00"), raw_row("x", "order-4", "c", "pickup", "2024-01-12T01:00:00")]))
        transform(spark, raw, f"{database}.facts", [D15], run_ts=RUN)
        wanted = delivery_facts(spark.table(raw), run_ts=RUN)
        assert state(spark.table(f"{database}.facts").select(*FACT.fieldNames())) == state(conform(wanted, FACT))

    def test_events_without_order_and_null_days(self, spark, raw):
        index = OrderIndex.build(spark, raw, buckets=3)
        loose = raw_frame(spark, [raw_row("e", "o", "c", "pickup", "2024-01-15T01:00:00")]).withColumn("order_id", F.lit(None).cast("string"))
        index.extend(loose)
        keys = spark.createDataFrame([("e",)], "event_id string")
        assert state(index.days_of(keys)) == [(D15,)] and state(index.orders_of(keys)) == []


class TestKeySketch:
    ROW = "event_id string, part string, event_date date, note string"

    def frame(self, spark, rows):
        return spark.createDataFrame(rows, self.ROW)

    @pytest.fixture
    def target(self, spark, database):
        rows = [(f"{d}-{i}", "p", date(2024, 1, d), "old") for d in range(1, 11) for i in range(50)] + [(None, "p", D13, "null")]
        table = f"{database}.t"
        upsert(self.frame(spark, rows), table, ["event_id"])
        return table

    def test_days_of_keys(self, spark, target):
        sketch = KeySketch.build(spark, target, ["event_id"])
        assert KeySketch.of(spark, target) == sketch
        keys = self.frame(spark, [("3-7", "p", D13, ""), ("8-0", "p", D13, ""), (None, "p", D13, ""), ("new", "p", D13, "")])
        assert sketch.days_of(keys) == {date(2024, 1, 3), date(2024, 1, 8)}
        append(self.frame(spark, [("new", "p", D14, "")]), target)
        assert sketch.days_of(keys) == {date(2024, 1, 3), date(2024, 1, 8), D14}
        assert sketch.days_of(keys.limit(0)) == set()

    @pytest.mark.parametrize("bits", [6, 20])
    def test_upserts_are_the_same(self, spark, target, bits, monkeypatch):
        sketch = KeySketch.build(spark, target, ["event_id"], bits)
        seen = []
        real = module._match_days
        monkeypatch.setattr(module, "_match_days", lambda s, t, k, i: seen.append(t) or real(s, t, k, i))
        source = [("3-7", "p", date(2024, 1, 3), "new"), ("8-0", "p", D14, "moved"), ("x", "p", D14, "first"), (None, "p", D14, "null")]
        assert upsert(self.frame(spark, source), target, ["event_id"]).dates == {date(2024, 1, 3), date(2024, 1, 8), D14}
        found = {r.event_id: (r.event_date, r.note) for r in spark.table(target).filter("note <> 'old' and event_id is not null").collect()}
        assert found == {r[0]: r[2:] for r in source[:3]}
        assert spark.table(target).count() == 503
        # the rows that moved are found on their new day
        upsert(self.frame(spark, [("8-0", "p", D15, "again")]), target, ["event_id"])
        assert spark.table(target).filter("event_id = '8-0'").collect()[0].event_date == D15
        if bits == 20:
            read = {f.split("event_date=")[1][:10] for f in seen[0].inputFiles()}
            assert read == {"2024-01-03", "2024-01-08"}
        # filters of other keys are not asked
        upsert(self.frame(spark, [("1-1", "p", D15, "by part")]), target, ["event_id", "part"])
        assert spark.table(target).filter("event_id = '1-1'").collect()[0].event_date == D15


class TestDeltas:
    def facts(self, spark, *changed, sla=48.0):
        rows = [raw_row(*e) for e in EVENTS] + [raw_row(*c) for c in changed]
        return conform(delivery_facts(raw_frame(spark, rows), sla_hours=sla, run_ts=RUN), FACT)

    def check(self, spark, facts, histogram):
        want = conform(courier_daily_kpis(spark.table(facts), RUN), KPI)
        assert state(conform(deltas.counted_kpis(spark, histogram, run_ts=RUN), KPI)) == state(want)

    def test_upserts_keep_the_histogram_in_step(self, spark, database):
        facts, histogram = f"{database}.facts", f"{database}.histogram"
        deltas.upsert_counted(self.facts(spark, sla=12.0), facts, histogram)
        self.check(spark, facts, histogram)
        late = ("evt-009", "order-4", "courier-D", "delivered", "2024-01-16T11:00:00")
        deltas.upsert_counted(self.facts(spark, late).filter("order_id = 'order-4'"), facts, histogram)
        self.check(spark, facts, histogram)
        moved = self.facts(spark).filter("order_id = 'order-2'").withColumn("event_date", F.lit(D13)).withColumn("courier_id", F.lit("courier-A"))
        deltas.upsert_counted(moved, facts, histogram)
        self.check(spark, facts, histogram)
        size = spark.table(histogram).count()
        deltas.upsert_counted(moved, facts, histogram)  # nothing changes, nothing is added
        assert spark.table(histogram).count() == size
        days = {r[0] for r in spark.table(histogram).select("event_date").distinct().collect()}
        assert deltas.fold(spark, histogram, days) < size
        self.check(spark, facts, histogram)
        one = deltas.counted_kpis(spark, histogram, [D14], RUN)
        assert {r["event_date"] for r in one.collect()} == {D14}

    @pytest.mark.parametrize("lost", ["facts", "settling"])
    def test_a_run_that_stops_in_between_is_made_up_for(self, spark, database, monkeypatch, lost):
        facts, histogram = f"{database}.facts", f"{database}.histogram"
        deltas.upsert_counted(self.facts(spark, sla=12.0), facts, histogram)

        def fail(*args, **kwargs):
            raise OSError("lost")

        with monkeypatch.context() as patched:
            if lost == "facts":
                patched.setattr(module, "_apply", fail)
            else:
                real = deltas._note
                patched.setattr(deltas, "_note", lambda s, t, days: real(s, t, days) if days else fail() if deltas.unsettled(s, t) else None)
            with pytest.raises(OSError):
                deltas.upsert_counted(self.facts(spark), facts, histogram)
        assert deltas.unsettled(spark, histogram) == {D13, D14, D15}
        deltas.upsert_counted(self.facts(spark).filter("order_id = 'order-1'"), facts, histogram)
        assert deltas.unsettled(spark, histogram) == set()
        self.check(spark, facts, histogram)

    def test_histogram_of_facts_that_were_there_before(self, spark, database):
        facts, histogram = f"{database}.facts", f"{database}.histogram"
        ensure_table(spark, facts, FACT)
        append(self.facts(spark), facts)
        deltas.upsert_counted(self.facts(spark).filter("order_id = 'order-1'"), facts, histogram)
        self.check(spark, facts, histogram)


class TestReconcile:
    def source(self, spark, days=20):
        rows = [
            raw_row(f"e{d}-{i}", f"o{i}", "c", "pickup", f"2024-01-{d:02d}T{i % 24:02d}:00:00", None if i % 3 else "CD001", None if i % 2 else "n")
            for d in range(1, days + 1) for i in range(200)
        ]
        return raw_frame(spark, rows).select(*SOURCE.fieldNames())

    def test_late_rows_of_any_age(self, spark, database):
        raw, log = f"{database}.raw", f"{database}.log"
        source = self.source(spark)
        late = F.col("event_id").isin("e2-7", "e2-8", "e9-100")
        run = utc("2024-01-21T00:00:00")
        ingest(spark, source.filter(~late), raw, log, run, start=watermark.EVERYTHING)
        assert ingest(spark, source, raw, log, run).rows == 0  # older than the overlap
        done = reconcile(spark, source, raw, run)
        assert (done.days, done.missing, done.surplus) == ({date(2024, 1, 2), date(2024, 1, 9)}, 3, 0)
        # a few buckets of 64 were compared, not two days of 200 events, and not all 4000
        assert done.buckets <= 3 and 3 <= done.compared <= 30
        assert spark.table(raw).count() == 4000
        assert reconcile(spark, source, raw, run) == (set(), 0, 0, 0, 0)

    def test_surplus_copies_and_changed_rows(self, spark, database):
        raw, log = f"{database}.raw", f"{database}.log"
        source = self.source(spark, 3)
        run = utc("2024-01-04T00:00:00")
        ingest(spark, source, raw, log, run, start=watermark.EVERYTHING)
        one = source.filter("event_id = 'e1-1'")
        twice = source.unionByName(one).unionByName(one)
        done = reconcile(spark, twice, raw, run)
        assert (done.days, done.missing, done.surplus) == ({date(2024, 1, 1)}, 2, 0)
        assert reconcile(spark, source, raw, run).surplus == 2
        # nulls that trade places with values are told apart
        swapped = twice.withColumn("status_code", F.when(F.col("event_id") == "e3-3", F.col("notes")).otherwise(F.col("status_code"))).withColumn(
            "notes", F.when(F.col("event_id") == "e3-3", F.lit(None)).otherwise(F.col("notes"))
        )
        done = reconcile(spark, swapped, raw, run)
        assert done.days <= {date(2024, 1, 3)}

    def test_empty_sides(self, spark, database):
        raw = f"{database}.raw"
        assert reconcile(spark, self.source(spark, 1).limit(0), raw, RUN).missing == 0
        assert reconcile(spark, self.source(spark, 1), raw, RUN).missing == 200


def test_sketches_merge_within_their_error(spark):
    facts = spark.range(60_000).select(
        F.concat(F.lit("c"), F.pmod("id", F.lit(2)).cast("string")).alias("courier_id"),
        F.expr("date_add(DATE'2024-01-01', cast(id % 14 as int))").alias("event_date"),
        F.when(F.col("id") % 10 != 0, F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)), 2) / 3600).alias("delivery_duration_hours"),
    )
    week = F.to_date(F.date_trunc("week", "event_date"))
    daily = duration_sketches(facts)
    assert daily.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    found = sketched_quantile(merged_sketches(daily.withColumn("week", week), ["courier_id", "week"])).collect()
    assert len(found) == 4
    for row in found:
        same = facts.filter((F.col("courier_id") == row.courier_id) & (week == F.lit(row.week)) & F.col("delivery_duration_hours").isNotNull())
        rank = same.agg(F.avg((F.col("delivery_duration_hours") <= row.p95_duration_hours).cast("int"))).first()[0]
        assert row.timed == same.count() and abs(rank - 0.95) <= RANK_ERROR


def test_quarantine_adds_up(spark, database):
    rows = [
        ("e1", "o", "c", "pickup", "2024-01-01 00:00:00", "1.5", None, None, "x", "extra"),
        ("e2", "o", None, "pickup", "yesterday", "1.5", None, None, None, "extra"),
        ("e3", "o", "c", "pickup", "2024-01-01 00:00:00", "far", "1e3", None, None, None),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in [*SOURCE.fieldNames(), "_row"]))
    table = f"{database}.refused"
    for _ in range(2):
        with staging(spark) as stage:
            good = accept(df, SOURCE, table, stage, RUN).collect()
        assert [r.event_id for r in good] == ["e1"] and good[0].location_lat == 1.5
    bad = spark.table(table).collect()
    assert len(bad) == 4 and {r["_quarantined_at"].day for r in bad} == {16}
    found = {F_id(r.row): [(p["column"], p["reason"], p["value"]) for p in r.problems] for r in bad}
    assert found == {
        "e2": [("courier_id", "missing", None), ("event_timestamp", "malformed", "yesterday")],
        "e3": [("location_lat", "malformed", "far")],
    }
    assert "extra" in next(r.row for r in bad if "e2" in r.row)
    with staging(spark) as stage, pytest.raises(ValueError, match="notes"):
        accept(df.drop("notes"), SOURCE, table, stage)


def F_id(row):
    import json

    return json.loads(row)["event_id"]


def test_cuts_follow_a_skewed_column(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.exp(F.col("id") / 2000)).alias("v"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pow(F.col("id"), 2).cast("long") % 86_400).alias("t"),
        F.expr("date_add(DATE'2024-01-01', cast(sqrt(id) as int))").alias("d"), (F.col("id") % 2).alias("flat"),
    )
    for column in ("v", "t", "d", "flat"):
        for sample in (1000, 100_000):
            cuts = quantile_cuts(rows, column, 6, sample)
            sizes = [rows.filter(p).count() for p in cut_predicates(column, cuts)]
            assert sum(sizes) == 20_000 and len(sizes) == len(cuts) + 1
            if column != "flat":
                middle = sorted(sizes)[len(sizes) // 2]
                assert len(sizes) == 6 and max(sizes) < 2 * middle
    assert cut_predicates("v", quantile_cuts(rows, "v", 1)) == ["1 = 1"]
    assert cut_predicates("v", quantile_cuts(rows.filter("v is null"), "v", 4)) == ["1 = 1"]
    assert cut_predicates("d", [D13, D14])[1] == "d >= DATE '2024-01-13' AND d < DATE '2024-01-14'"
    with pytest.raises(ValueError):
        quantile_cuts(rows, "v", 0)
