"""The order mart: orders joined to their dimensions, with six defect flags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustline.functions import flags
from trustline.operators import duplicates as dup
from trustline.operators.ranking import row_number_within
from trustline.sources.schemas import FCT_ORDERS

# The first row of an order: earliest date (unknown dates last); the rest makes ties repeatable.
FIRST_ROW = dup.Ordering(("order_date", "product_id", "total_amount", "customer_id", "status"))


def as_of_date(as_of: dt.date | str | None) -> Column:
    """``as_of`` as a DATE column; today when not given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def join_customers(orders: DataFrame, customers: DataFrame, *keep: str) -> DataFrame:
    """Left join; ``matched_customer_id`` is NULL where no customer was found.

    ``keep`` names further columns of the dimension.

    No broadcast hint on purpose: Spark broadcasts a dimension that its statistics
    (or AQE's measured sizes) put under the threshold, and otherwise sort-merges,
    where AQE splits the partition of a hot or NULL customer.
    """
    dim = customers.select(
        F.col("customer_id").alias("matched_customer_id"),
        F.col("name").alias("customer_name"),
        F.col("region").alias("customer_region"),
        *keep,
    )
    return orders.join(dim, F.col("customer_id") == F.col("matched_customer_id"), "left")


def join_products(orders: DataFrame, products: DataFrame, *keep: str) -> DataFrame:
    dim = products.select(
        F.col("product_id").alias("matched_product_id"),
        "product_name",
        "category",
        F.col("price").alias("unit_price"),
        *keep,
    )
    return orders.join(dim, F.col("product_id") == F.col("matched_product_id"), "left")


def _ranked(dim: DataFrame, key: str, name: str, *attributes: str) -> DataFrame:
    """Rows of a dimension with a key, and ``name``: FALSE for one row of a key, the first by a hash of its attributes.

    Of the rows that an order is fanned out to, those of a later dimension row are duplicates by this
    alone, so that neither hash nor attributes pass the window where nobody reads them.
    """
    until = Window.partitionBy(key).orderBy(F.xxhash64(*attributes)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dim.where(F.col(key).isNotNull()).withColumn(name, F.count("*").over(until) > 1)


def flagged_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: dt.date | str | None,
    hot: DataFrame | None = None,
    last_ties: tuple[str, ...] = (),
    products_first: bool = True,
) -> DataFrame:
    """All order rows with attributes and flags, keeping the orders' extra columns.

    A repeated dimension key, which fans orders out, shows up as duplicates: the first row of an order is
    the first of its order rows, with the first row of each dimension.  So the window needs no dimension, and
    what is joined after it is not shuffled with it.  ``hot`` is :func:`duplicates.hot_buckets` of
    the order ids where the caller has a cheaper way to count them; they are counted here.

    ``products_first`` is for orders that were made by a join with products on their id: they are dealt
    by it, so that the join before the window costs no shuffle.  Others carry fewer columns without it.
    """
    order = dup.Ordering(FIRST_ROW.columns + last_ties)
    hot = dup.found(hot if hot is not None else dup.hot_buckets(orders, "order_id"))
    customers = _ranked(customers, "customer_id", "_customer", "name", "region")
    products = _ranked(products, "product_id", "_product", "product_name", "category", "price")
    total, status = F.col("total_amount"), F.col("status")
    no = F.lit(False)

    # Flags on what a join found are made with it: the columns behind them pass no further shuffle.
    def with_products(rows: DataFrame) -> DataFrame:
        error = flags.math_error(total, F.col("quantity"), F.col("unit_price"))
        return join_products(rows, products, "_product").withColumn("has_math_error", error)

    rows = dup.with_salt(orders, "order_id", hot)
    rows = with_products(rows) if products_first else rows
    numbered = dup.number_in_group(rows, order, ["_product"] if products_first else [])
    rows = dup.flagged(numbered, orders, "order_id", order, "is_duplicate", hot)
    rows = join_customers(rows, customers, "_customer").withColumns(
        {
            "is_orphan_order": flags.orphan(F.col("matched_customer_id")),
            "is_duplicate": F.col("is_duplicate") | F.coalesce("_customer", no),
        }
    )
    if not products_first:
        rows = with_products(rows).withColumn("is_duplicate", F.col("is_duplicate") | F.coalesce("_product", no))
    flagged = (
        rows.withColumn("has_negative_amount", flags.negative_amount(total))
        .withColumn("is_future_order", flags.future(F.col("order_date"), as_of_date(as_of)))
        .withColumn("has_bad_status", flags.bad_status(status))
    )
    extra = [c for c in orders.columns if c not in FCT_ORDERS.names]
    return flagged.select(*FCT_ORDERS.names, *extra)


def fct_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: dt.date | str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """The mart: one row per order row and dimension match, 18 columns."""
    return flagged_orders(orders, customers, products, as_of, hot).select(*FCT_ORDERS.names)


def dirty_orders(fct: DataFrame) -> DataFrame:
    return fct.where(flags.dirty())


def clean_orders(fct: DataFrame) -> DataFrame:
    return fct.where(~flags.dirty())


def order_row_number(orders: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Place of each row among the rows of its order, by date (see ``ranking``)."""
    return row_number_within(orders, "order_id", FIRST_ROW, "row_number", hot=hot)


def derive_order_total(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Look up the price of each line and set total_amount = round(price x quantity, 2)."""
    price = products.select("product_id", F.col("price").alias("unit_price"))
    return lines.join(price, "product_id").withColumn(
        "total_amount", F.round(F.col("unit_price") * F.col("quantity"), 2)
    )
