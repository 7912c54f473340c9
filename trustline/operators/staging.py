"""Typed projections of the raw tables; a cast that fails gives NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.functions.casts import safe_date, safe_double, safe_int


def _text(name: str):
    return F.col(name).cast("string").alias(name)


def _extra(raw: DataFrame, used: set[str]) -> list[str]:
    """Carried-along columns of the raw frame (row identity, batch date, markers)."""
    return [c for c in raw.columns if c not in used]


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("customer_id"),
        _text("name"),
        _text("email"),
        _text("region"),
        safe_date(F.col("signup_date")).alias("signup_date"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("product_id"),
        _text("product_name"),
        _text("category"),
        safe_double(F.col("price")).alias("price"),
        safe_int(F.col("stock_level")).alias("stock_level"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """Stage orders; columns beyond the seven raw ones are kept at the end."""
    typed = [
        _text("order_id"),
        _text("customer_id"),
        _text("product_id"),
        safe_int(F.col("quantity")).alias("quantity"),
        safe_double(F.col("total_amount")).alias("total_amount"),
        safe_date(F.col("order_date")).alias("order_date"),
        F.upper(F.col("status").cast("string")).alias("status"),
    ]
    names = {
        "order_id", "customer_id", "product_id", "quantity", "total_amount", "order_date", "status",
    }
    return raw.select(*typed, *_extra(raw, names))
