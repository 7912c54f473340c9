"""Daily rollup of the mart: the table every report reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustline.functions import flags

# Rollup measure -> mart flag it counts.
DEFECT_MEASURES = {
    "orphan_orders": "is_orphan_order",
    "negative_amount_orders": "has_negative_amount",
    "duplicate_orders": "is_duplicate",
    "future_orders": "is_future_order",
    "math_errors": "has_math_error",
    "bad_status_orders": "has_bad_status",
}


def clean_amount() -> Column:
    """The amount of clean rows, 0 for dirty ones."""
    return F.when(flags.dirty(), F.lit(0.0)).otherwise(F.col("total_amount"))


def defect_count_columns() -> list[Column]:
    return [F.count_if(F.col(flag)).alias(name) for name, flag in DEFECT_MEASURES.items()]


def daily_status_rollup(fct: DataFrame, *also: str) -> DataFrame:
    """Counts, reported and clean revenue and six defect counts per (order_date, status), and ``also`` by more columns."""
    return fct.groupBy(*also, "order_date", "status").agg(
        F.count("*").alias("order_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum(clean_amount()).alias("clean_revenue"),
        *defect_count_columns(),
    )


def merge_rollups(cells: DataFrame) -> DataFrame:
    """The rollup of a table from the rollups of its parts; sums of nothing but unknown amounts stay unknown."""
    sums = ["order_count", "total_revenue", "clean_revenue", *DEFECT_MEASURES]
    return cells.groupBy("order_date", "status").agg(*[F.sum(c).alias(c) for c in sums])


def clean_revenue_by_date(fct: DataFrame) -> DataFrame:
    return fct.groupBy("order_date").agg(F.sum(clean_amount()).alias("clean_revenue"))


def defect_counts(fct: DataFrame) -> DataFrame:
    return fct.agg(F.count("*").alias("order_count"), *defect_count_columns())
