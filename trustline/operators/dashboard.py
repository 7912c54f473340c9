"""Report tables, all derived from the rollup feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustline.functions.flags import status_bucket
from trustline.operators.mart import as_of_date
from trustline.operators.rollup import DEFECT_MEASURES

# Measure, label, impact and sentence of each issue, in report order.
ISSUES = [
    (
        "orphan_orders",
        "Orphan Orders (FK Failure)",
        "High",
        "Found %d orders referencing non-existent customers (Referential Integrity).",
    ),
    (
        "negative_amount_orders",
        "Negative Amounts (Domain Error)",
        "High",
        "Found %d orders with negative total amounts (Domain Error).",
    ),
    (
        "duplicate_orders",
        "Duplicate Orders (Uniqueness)",
        "Critical",
        "Found %d duplicate orders (Uniqueness Violation).",
    ),
    (
        "future_orders",
        "Future Dates (Temporal Validity)",
        "Medium",
        "Found %d orders with future dates (Time Travel / Temporal Validity).",
    ),
    (
        "math_errors",
        "Math Mismatch (Calculation Integrity)",
        "Medium",
        "Found %d orders where Total != Price * Qty (Calculation Integrity).",
    ),
    (
        "bad_status_orders",
        "Invalid Status (String Inconsistency)",
        "Low",
        "Found %d orders with invalid status strings (Consistency / Dirty Data).",
    ),
]

_REVENUE = ["total_revenue", "clean_revenue"]


def _total(feed: DataFrame, measure: str) -> Column:
    """Sum of a measure; 0 when the feed is empty or lacks the column."""
    if measure not in feed.columns:
        return F.lit(0).cast("bigint").alias(measure)
    return F.coalesce(F.sum(measure), F.lit(0)).alias(measure)


def kpis(feed: DataFrame) -> DataFrame:
    """One row: orders, revenue, the six defect counts and their sum."""
    totals = feed.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        *[_total(feed, measure) for measure in DEFECT_MEASURES],
    )
    incidents = sum((F.col(m) for m in DEFECT_MEASURES), F.lit(0).cast("bigint"))
    return totals.withColumn("incidents", incidents)


def _with_score(totals: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("incidents"), F.col("total_orders"))
    score = F.when(F.col("total_orders") > 0, F.greatest(F.lit(0.0), 100 - share * 100))
    return totals.withColumn("health_score", score.otherwise(F.lit(100.0))).withColumn(
        "shortfall", 100 - F.col("health_score")
    )


def health_score(feed: DataFrame) -> DataFrame:
    """Score 0-100: share of orders left after subtracting incidents; 100 without orders.

    A row can carry several flags, so incidents may exceed orders: clamped at 0.
    """
    return _with_score(kpis(feed)).select("total_orders", "incidents", "health_score", "shortfall")


def kpi_cards(feed: DataFrame) -> DataFrame:
    """The four headline numbers as display text, with the change shown below each."""
    return _with_score(kpis(feed)).select(
        F.format_string("%.1f%%", "health_score").alias("health_score"),
        F.when(F.col("health_score") < 100, F.format_string("-%.1f%%", "shortfall"))
        .otherwise("0%")
        .alias("health_delta"),
        F.concat(F.lit("$"), F.format_number("total_revenue", 2)).alias("total_revenue"),
        F.format_number("total_orders", 0).alias("total_orders"),
        F.col("incidents").cast("string").alias("incidents"),
        F.when(F.col("incidents") > 0, "High Severity").otherwise("Clean").alias("incident_delta"),
    )


def business_view(feed: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Feed rows up to ``as_of``; future and unknown dates drop out."""
    return feed.where(F.col("order_date") <= as_of_date(as_of))


def daily_revenue(feed: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Reported and clean revenue per day of the business view, in date order."""
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in _REVENUE]
    return business_view(feed, as_of).groupBy("order_date").agg(*sums).orderBy("order_date")


def daily_revenue_long(feed: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """:func:`daily_revenue` with one row per day and measure."""
    return daily_revenue(feed, as_of).unpivot("order_date", _REVENUE, "Metric", "Amount")


def revenue_at_risk(feed: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Reported less clean revenue of the business view; may be negative."""
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in _REVENUE]
    totals = business_view(feed, as_of).agg(*sums)
    return totals.withColumn("revenue_at_risk", F.col("total_revenue") - F.col("clean_revenue"))


def risk_message(feed: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    amount = F.format_number("revenue_at_risk", 2)
    return revenue_at_risk(feed, as_of).select(
        F.concat(
            F.lit("Financial Risk Detected: $"),
            amount,
            F.lit(" of reported revenue is compromised by data quality issues."),
        ).alias("message")
    )


def status_buckets(feed: DataFrame) -> DataFrame:
    """Orders per valid status, all other statuses in one bucket; future rows included."""
    return (
        feed.groupBy(status_bucket(F.col("status")).alias("status_group"))
        .agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"))
        .orderBy("status_group")
    )


def _issues(feed: DataFrame) -> DataFrame:
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(label).alias("issue_type"),
            F.col(measure).alias("issue_count"),
            F.lit(impact).alias("impact"),
            F.format_string(sentence, F.col(measure)).alias("message"),
        )
        for i, (measure, label, impact, sentence) in enumerate(ISSUES)
    ]
    return kpis(feed).select(F.inline(F.array(*rows)))


def issue_breakdown(feed: DataFrame) -> DataFrame:
    """Six rows: issue, count, impact."""
    return _issues(feed).select("position", "issue_type", "issue_count", "impact")


def issue_drilldown(feed: DataFrame) -> DataFrame:
    """A sentence for each issue that occurs."""
    return _issues(feed).where(F.col("issue_count") > 0).select("position", "issue_type", "message")
