"""The known case of ten events, and the edges of its rules."""

from fixtures import DAY, four_orders, raw_frame, raw_row
from pyspark.sql import functions as F

from parcel_engine.functions.delivery import late_reason, reason_for_status
from parcel_engine.operators import (
    courier_daily_kpis,
    dedup_latest,
    delivery_facts,
    enrich_orders,
    order_summary,
)


def facts_by_event(facts):
    columns = [
        F.date_format("pickup_time", "MM-dd HH:mm").alias("pickup"),
        F.date_format("delivery_time", "MM-dd HH:mm").alias("delivery"),
        "delivery_duration_hours",
        "is_failed",
        "is_on_time",
        "late_reason",
    ]
    return {r[0]: tuple(r[1:]) for r in facts.select("event_id", *columns).collect()}


ORDER_1 = ("01-14 08:00", "01-15 08:00", 24.0, False, True, None)
ORDER_2 = ("01-13 06:00", "01-15 18:00", 60.0, False, False)
ORDER_3 = ("01-15 07:05", None, None, True, None)
ORDER_4 = ("01-15 10:00", None, None, False, None, None)
GOLDEN = {
    "evt-001": ORDER_1,
    "evt-002": ORDER_1,
    "evt-003": ORDER_1,
    "evt-004": (*ORDER_2, None),
    "evt-005": (*ORDER_2, "courier_delay"),
    "evt-006": (*ORDER_3, None),
    "evt-007": (*ORDER_3, "address_issue"),
    "evt-008": ORDER_4,
    "evt-009": ORDER_4,
}


class TestDedup:
    def test_one_row_per_event(self, spark):
        latest = dedup_latest(four_orders(spark))
        assert latest.count() == 9
        assert latest.filter("event_id = 'evt-006'").count() == 1

    def test_latest_version_survives(self, spark):
        row = dedup_latest(four_orders(spark)).filter("event_id = 'evt-006'").first()
        assert row["notes"] == "retry"
        assert row["event_timestamp"].minute == 5

    def test_idempotent(self, spark):
        once = dedup_latest(four_orders(spark))
        assert sorted(once.collect()) == sorted(dedup_latest(once).collect())

    def test_ties_do_not_depend_on_row_order(self, spark):
        rows = [
            raw_row("e", "o", "c", "pickup", "2024-01-15T07:00:00", notes=f"copy {i}")
            for i in range(20)
        ]
        kept = {
            dedup_latest(raw_frame(spark, some)).first()["notes"]
            for some in (rows, rows[::-1], rows[7:] + rows[:7])
        }
        assert kept == {"copy 0"}

    def test_tie_goes_to_the_later_ingest(self, spark):
        at = "2024-01-15T07:00:00"
        rows = [
            raw_row("e", "o", "c", "pickup", at, notes="new", ingested="2024-01-15T08:00:00"),
            raw_row("e", "o", "c", "pickup", at, notes="old", ingested="2024-01-15T07:30:00"),
        ]
        assert dedup_latest(raw_frame(spark, rows)).first()["notes"] == "new"

    def test_narrow_projection_keeps_the_same_version(self, spark):
        at = "2024-01-15T07:00:00"
        rows = [
            raw_row("e", "o2", "c1", "pickup", at, notes="a"),
            raw_row("e", "o1", "c2", "failed", at, notes="z"),
            raw_row("e", "o1", "c3", "delivered", at, notes="b"),
        ]
        raw = raw_frame(spark, rows)
        narrow = ["event_id", "order_id", "event_type", "event_timestamp", "_ingested_at"]
        full = dedup_latest(raw).select(narrow).collect()
        assert full == dedup_latest(raw.select(narrow)).collect()


class TestFacts:
    def test_known_case(self, spark):
        assert facts_by_event(delivery_facts(four_orders(spark))) == GOLDEN

    def test_history_scope_on_true_days(self, spark):
        raw = four_orders(spark, one_day=False)
        assert facts_by_event(delivery_facts(raw)) == GOLDEN

    def test_date_scope_on_true_days(self, spark):
        raw = four_orders(spark, one_day=False)
        rows = delivery_facts(raw, scope="date").collect()
        assert len(rows) == 9
        assert all(r["delivery_duration_hours"] is None for r in rows)
        assert all(r["is_on_time"] is None for r in rows)
        reasons = {r["event_id"]: r["late_reason"] for r in rows if r["late_reason"]}
        assert reasons == {"evt-007": "address_issue"}

    def test_columns(self, spark):
        facts = delivery_facts(four_orders(spark))
        assert len(facts.columns) == 18
        assert facts.columns[0] == "event_id" and facts.columns[-1] == "_transformed_at"

    def order(self, spark, *events, **options):
        rows = [
            raw_row(f"e{i}", "o", "c", kind, at, *rest)
            for i, (kind, at, *rest) in enumerate(events)
        ]
        return delivery_facts(raw_frame(spark, rows), **options).orderBy("event_id").collect()

    def test_limit_is_inclusive(self, spark):
        start = ("pickup", "2024-01-01T00:00:00")
        exact = self.order(spark, start, ("delivered", "2024-01-03T00:00:00"))
        over = self.order(spark, start, ("delivered", "2024-01-03T00:00:01"))
        assert {r["is_on_time"] for r in exact} == {True}
        assert {r["is_on_time"] for r in over} == {False}
        looser = self.order(
            spark, start, ("delivered", "2024-01-03T00:00:01"), sla_hours=72
        )
        assert {r["is_on_time"] for r in looser} == {True}

    def test_negative_duration_is_on_time(self, spark):
        rows = self.order(
            spark, ("delivered", "2024-01-01T00:00:00"), ("pickup", "2024-01-01T02:00:00")
        )
        assert {r["delivery_duration_hours"] for r in rows} == {-2.0}
        assert {r["is_on_time"] for r in rows} == {True}

    def test_earliest_of_each_type(self, spark):
        rows = self.order(
            spark,
            ("pickup", "2024-01-01T05:00:00"),
            ("pickup", "2024-01-01T03:00:00"),
            ("delivered", "2024-01-01T09:00:00"),
            ("delivered", "2024-01-01T08:00:00"),
        )
        assert {r["delivery_duration_hours"] for r in rows} == {5.0}

    def test_seconds_are_whole(self, spark):
        rows = self.order(
            spark,
            ("pickup", "2024-01-01T00:00:00.100000"),
            ("delivered", "2024-01-01T00:00:01.900000"),
        )
        assert {r["delivery_duration_hours"] for r in rows} == {1 / 3600.0}

    def test_delivered_and_failed(self, spark):
        rows = self.order(
            spark,
            ("pickup", "2024-01-01T00:00:00"),
            ("failed", "2024-01-01T01:00:00", "NP002"),
            ("delivered", "2024-01-01T02:00:00", "ZZ999"),
        )
        assert {r["is_failed"] for r in rows} == {True}
        assert {r["is_on_time"] for r in rows} == {True}
        assert [r["late_reason"] for r in rows] == [None, "no_pickup", None]

    def test_no_reason_for_on_time_order(self, spark):
        rows = self.order(
            spark,
            ("pickup", "2024-01-01T00:00:00", "CD001"),
            ("delivered", "2024-01-01T02:00:00", "AI001"),
        )
        assert {r["late_reason"] for r in rows} == {None}

    def test_events_without_order(self, spark):
        loose = raw_frame(
            spark, [raw_row("e1", "o", "c", "pickup", "2024-01-01T00:00:00")]
        ).withColumn("order_id", F.lit(None).cast("string"))
        row = delivery_facts(loose).first()
        assert row["pickup_time"] is None and row["is_failed"] is None


class TestSummaryAndReasons:
    def test_window_free_summary(self, spark):
        rows = order_summary(dedup_latest(four_orders(spark))).collect()
        sizes = {r["order_id"]: r["event_count"] for r in rows}
        assert sizes == {"order-1": 3, "order-2": 2, "order-3": 2, "order-4": 2}

    def test_every_event_stays(self, spark):
        latest = dedup_latest(four_orders(spark))
        summary = order_summary(latest)
        for slices in (1, 3, 100):
            assert enrich_orders(latest, summary, slices=slices).count() == 9

    def test_ungated_reason(self, spark):
        rows = (
            four_orders(spark).withColumn("reason", reason_for_status()).collect()
        )
        reasons = {r["event_id"]: r["reason"] for r in rows}
        assert reasons["evt-005"] == "courier_delay"
        assert reasons["evt-007"] == "address_issue"
        assert reasons["evt-001"] is None

    def test_first_rule_wins_and_empty_rules(self, spark):
        df = spark.createDataFrame(
            [("X", True, None), ("Y", True, None), ("X", None, True), ("X", None, False)],
            "status_code string, is_failed boolean, is_on_time boolean",
        )
        rules = {"none": [], "first": ["X"], "second": ["X", "Y"]}
        got = [r[0] for r in df.select(late_reason(rules)).collect()]
        assert got == ["first", "second", None, "first"]
        assert [r[0] for r in df.select(late_reason({})).collect()] == [None] * 4

    def test_three_valued_gate(self, spark):
        df = spark.createDataFrame(
            [(t, f) for t in (True, False, None) for f in (True, False, None)],
            "is_on_time boolean, is_failed boolean",
        ).withColumn("status_code", F.lit("CD001"))
        rows = df.select("is_on_time", "is_failed", late_reason().alias("reason")).collect()
        got = {(r[0], r[1]): r[2] for r in rows}
        given = {k for k, v in got.items() if v == "courier_delay"}
        assert given == {
            (True, True), (False, True), (None, True), (False, False), (False, None)
        }


class TestKpis:
    GOLDEN = {
        "courier-A": (3, 1, 0, 3, 100.0, 24.0, 24.0),
        "courier-B": (2, 1, 0, 0, 0.0, 60.0, 60.0),
        "courier-C": (2, 0, 2, 0, None, None, None),
        "courier-D": (2, 0, 0, 0, None, None, None),
    }

    def kpis(self, facts, **options):
        rows = courier_daily_kpis(facts, **options).collect()
        assert {r["event_date"] for r in rows} == {DAY}
        return {r["courier_id"]: tuple(r[2:9]) for r in rows}

    def test_known_case(self, spark):
        facts = delivery_facts(four_orders(spark))
        assert self.kpis(facts) == self.GOLDEN
        assert self.kpis(facts, approximate_p95=True) == self.GOLDEN

    def facts(self, spark, durations):
        rows = [
            ("c", DAY, "in-transit", False, None if d is None else d <= 48.0, d)
            for d in durations
        ]
        return spark.createDataFrame(
            rows,
            "courier_id string, event_date date, event_type string, is_failed boolean,"
            " is_on_time boolean, delivery_duration_hours double",
        )

    def test_percentile_is_the_discrete_one(self, spark):
        for n in (1, 2, 19, 20, 21, 40, 100, 101):
            durations = [float(i) for i in range(1, n + 1)] + [None, None]
            row = self.kpis(self.facts(spark, durations))["c"]
            assert row[6] == float(-(-95 * n // 100)), n

    def test_percentile_weights_repeated_durations(self, spark):
        row = self.kpis(self.facts(spark, [1.0] * 94 + [50.0] * 6))["c"]
        assert row == (100, 0, 0, 94, 94.0, 3.94, 50.0)
        row = self.kpis(self.facts(spark, [1.0] * 95 + [50.0] * 5))["c"]
        assert row[6] == 1.0

    def test_halves_round_away_from_zero(self, spark):
        assert self.kpis(self.facts(spark, [1.005]))["c"][5] == 1.01
        assert self.kpis(self.facts(spark, [-0.125]))["c"][5] == -0.13
        assert self.kpis(self.facts(spark, [1.0025, 1.0075]))["c"][5] == 1.01


def test_a_mean_is_rounded_once(spark):
    """1,200,000 events, one a second shorter: the mean is just below a half hundredth."""
    hours = F.when(F.col("id") == 0, F.lit(86417)).otherwise(F.lit(86418)) / 3600.0
    facts = spark.range(1_200_000).select(
        F.lit("c").alias("courier_id"),
        F.lit("2024-01-15").cast("date").alias("event_date"),
        F.lit("delivered").alias("event_type"),
        hours.alias("delivery_duration_hours"),
        F.lit(False).alias("is_failed"),
        F.lit(True).alias("is_on_time"),
    )
    row = courier_daily_kpis(facts).first()
    assert (row["avg_duration_hours"], row["on_time_rate_pct"]) == (24.0, 100.0)
