"""Report tables, monitors and the date window on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trustline.operators import calendar, dashboard, monitors
from trustline.sources import schemas

AS_OF = dt.date(2024, 3, 10)
D1, D2, LATER = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2030, 1, 1)


def feed_row(date, status="PENDING", n=10, total=100.0, clean=80.0, defects=(0, 0, 0, 0, 0, 0)):
    return (date, status, n, total, clean, *defects)


@pytest.fixture(scope="module")
def feed(spark):
    rows = [
        feed_row(D1, defects=(1, 0, 0, 0, 2, 0)),
        feed_row(D1, "SHIPPED", 5, 50.0, 50.0),
        feed_row(D2, "oops", 3, -30.0, 0.0, (0, 3, 0, 0, 3, 3)),
        feed_row(LATER, None, 2, 20.0, 0.0, (0, 0, 0, 2, 0, 2)),
        feed_row(None, "PENDING", 1, None, None),
    ]
    return spark.createDataFrame(rows, schemas.FEED)


def test_kpis(feed):
    row = dashboard.kpis(feed).first()
    assert (row.total_orders, row.total_revenue, row.incidents) == (21, 140.0, 16)
    assert row.math_errors == 5 and row.duplicate_orders == 0


def test_missing_measures_count_as_zero(feed):
    row = dashboard.kpis(feed.drop("math_errors", "bad_status_orders")).first()
    assert (row.math_errors, row.bad_status_orders, row.incidents) == (0, 0, 6)


def test_score(spark, feed):
    row = dashboard.health_score(feed).first()
    assert row.health_score == pytest.approx(100 - 16 / 21 * 100)
    assert row.shortfall == pytest.approx(16 / 21 * 100)
    empty = spark.createDataFrame([], schemas.FEED)
    assert dashboard.health_score(empty).first().health_score == 100.0
    crowded = spark.createDataFrame([feed_row(D1, n=1, defects=(1, 1, 1, 0, 0, 0))], schemas.FEED)
    assert dashboard.health_score(crowded).first().health_score == 0.0


def test_cards(spark, feed):
    assert tuple(dashboard.kpi_cards(feed).first()) == (
        "23.8%", "-76.2%", "$140.00", "21", "16", "High Severity",
    )
    empty = spark.createDataFrame([], schemas.FEED)
    assert tuple(dashboard.kpi_cards(empty).first()) == ("100.0%", "0%", "$0.00", "0", "0", "Clean")


def test_business_view_and_daily(feed):
    assert dashboard.business_view(feed, AS_OF).count() == 3
    daily = dashboard.daily_revenue(feed, AS_OF).collect()
    assert [tuple(r) for r in daily] == [(D1, 150.0, 130.0), (D2, -30.0, 0.0)]
    long = dashboard.daily_revenue_long(feed, AS_OF)
    assert long.columns == ["order_date", "Metric", "Amount"] and long.count() == 4


def test_risk_may_be_negative_per_day(feed):
    assert dashboard.revenue_at_risk(feed, AS_OF).first().revenue_at_risk == -10.0
    assert "$-10.00 of reported" in dashboard.risk_message(feed, AS_OF).first().message


def test_status_buckets_include_the_future(feed):
    assert [tuple(r) for r in dashboard.status_buckets(feed).collect()] == [
        ("INVALID/DIRTY", 5), ("PENDING", 11), ("SHIPPED", 5),
    ]


def test_issues(feed):
    table = dashboard.issue_breakdown(feed).orderBy("position").collect()
    assert [r.issue_count for r in table] == [1, 3, 0, 2, 5, 5]
    assert [r.impact for r in table] == ["High", "High", "Critical", "Medium", "Medium", "Low"]
    shown = dashboard.issue_drilldown(feed).orderBy("position").collect()
    assert [r.position for r in shown] == [1, 2, 4, 5, 6]
    assert shown[0].message == "Found 1 orders referencing non-existent customers (Referential Integrity)."


# --- monitors -------------------------------------------------------------------------


def test_freshness_ignores_the_future(spark, feed):
    empty = feed.limit(0)
    rows = monitors.freshness({"feed": (feed, "order_date"), "none": (empty, "order_date")}, AS_OF).collect()
    assert {tuple(r) for r in rows} == {("feed", D2, 8), ("none", None, None)}


def test_volume_anomaly(spark):
    counts = [10, 12] * 10 + [60, 11]
    days = [(D1 + dt.timedelta(days=i), n) for i, n in enumerate(counts)]
    df = spark.createDataFrame(days, "order_date date, n int").withColumn("x", F.explode(F.sequence(F.lit(1), "n")))
    rows = monitors.volume_anomaly(df, as_of=LATER).orderBy("order_date").collect()
    assert [i for i, r in enumerate(rows) if r.is_anomaly] == [20]
    assert all(r.z_score is None for r in rows[:14]) and rows[14].expected == 11.0


def test_volume_without_spread_is_no_anomaly(spark):
    days = [(D1 + dt.timedelta(days=i),) for i in range(20)]
    rows = monitors.volume_anomaly(spark.createDataFrame(days, "order_date date"), as_of=LATER).collect()
    assert len(rows) == 20 and not any(r.is_anomaly for r in rows)


def test_schema_check(spark):
    df = spark.createDataFrame([], "customer_id string, name int, region string, age int")
    found = {r.column_name: r.status for r in monitors.schema_check(df, schemas.RAW_CUSTOMERS).collect()}
    assert found == {
        "customer_id": "ok", "name": "type_mismatch", "email": "missing", "signup_date": "missing",
        "region": "ok", "age": "extra",
    }


def test_load_row_counts(spark):
    counts = monitors.load_row_counts({"A": spark.range(3), "B": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("A", 3), ("B", 0)]


# --- date window ----------------------------------------------------------------------


def marks(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "batch_date date")


def window(spark, *days):
    mark = calendar.high_water_mark(marks(spark, *days), as_of=AS_OF)
    return calendar.incremental_window(mark, AS_OF)


def test_window_defaults_to_yesterday(spark):
    assert tuple(window(spark).first()) == (AS_OF, AS_OF, 1)


def test_window_after_the_latest_mark(spark):
    assert tuple(window(spark, D1, D2).first()) == (dt.date(2024, 3, 3), AS_OF, 8)
    assert calendar.days_of(window(spark, D1, D2)).count() == 8


def test_window_is_empty_when_caught_up(spark):
    assert window(spark, AS_OF).first().day_count == 0
    assert calendar.days_of(window(spark, AS_OF)).count() == 0
    assert window(spark, LATER).first().day_count == 0


def test_spine_and_missing_days(spark):
    spine = calendar.date_spine(spark, dt.date(2023, 3, 11), AS_OF)
    assert spine.count() == 366
    spine = calendar.date_spine(spark, "2024-02-28", D2)
    absent = calendar.missing_days(spine, marks(spark, D1, D1, dt.date(2024, 2, 28)))
    assert sorted(r.day for r in absent.collect()) == [dt.date(2024, 2, 29), D2]


def test_a_day_without_rows_counts_zero(spark):
    days = [(D1 + dt.timedelta(days=i),) for i in range(30) if i != 20 for _ in range(10 + i % 2)]
    rows = monitors.volume_anomaly(spark.createDataFrame(days, "order_date date"), as_of=LATER).orderBy("order_date").collect()
    assert len(rows) == 30 and rows[20].row_count == 0 and [i for i, r in enumerate(rows) if r.is_anomaly] == [20]
