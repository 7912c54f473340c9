"""The raw tables of the quality pipeline, derived from the star-schema test tables.

``lineitem`` rows become orders (its line keys repeat, which gives natural
duplicates), ``customer`` and ``part`` become the dimensions, ``events`` becomes the
daily batch source.  Defects are seeded with the hash selection of
``functions.hashing``, so an engine with md5 can rebuild the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustline.functions.hashing import selected_sql
from trustline.sources.tables import row_identity

# Fixed values of the test tables.
AS_OF = "2001-06-30"
EVENTS_AS_OF = "2024-02-05"
SEED_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SEED_SHARE = 0.05
FUTURE_TEXT = "2030-01-01"
BAD_DATE_TEXT = "not-a-date"
STATUS_TYPOS = ["Completado", "completed", "Shipped!", "Pending...", "Cancelled (User)"]


# Columns of the test tables that are read here; naming them saves a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(amount: str) -> str:
    """Two-digit text of an amount."""
    return f"CAST(CAST(round({amount}, 2) AS DECIMAL(18,2)) AS STRING)"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "CAST(c_custkey AS STRING) AS customer_id",
            "c_name AS name",
            "concat(lower(replace(c_name, '#', '')), '@example.com') AS email",
            "CAST(date_add(DATE '1995-01-01', CAST(c_custkey % 730 AS INT)) AS STRING) AS signup_date",
            "r_name AS region",
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "p_type AS category",
        f"{money('p_retailprice')} AS price",
        "CAST(p_size AS STRING) AS stock_level",
        "p_name AS product_name",
    )


_ORDER_ID = "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))"
_SHIP_DAY = "CAST(l_shipdate AS STRING)"  # a date already
_CUSTOMER = "CAST(o_custkey AS STRING)"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'SHIPPED' END"
_TYPO = f"element_at(array({', '.join(repr(t) for t in STATUS_TYPOS)}), CAST(l_linenumber % 5 + 1 AS INT))"


def _lines(spark: SparkSession, sf_dir: str, dealt: bool = False, **also: str) -> DataFrame:
    """lineitem with its order's customer and status and its part's price, and ``also`` by name.

    Parts are joined by their number as text, which is the product id: later joins by it find the rows dealt.
    ``dealt`` is for those who join products next.  Part numbers and prices are far smaller than products, so
    they may be broadcast where products are not; then rows would be dealt for products all the same, and
    wider ones.
    What lineitem alone decides is made before the joins, so that what it is made from is not shuffled.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    part = part.hint("merge") if dealt else part
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            *SEED_KEYS, "l_quantity", F.expr("CAST(l_shipdate AS DATE) AS l_shipdate"), row_identity(),
            *[F.expr(f"{sql} AS {name}") for name, sql in also.items()],
        )
        .join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(part, F.expr("CAST(l_partkey AS STRING) = CAST(p_partkey AS STRING)"))
    )


def _raw_order_columns(customer: str, factor: str, date: str, status: str) -> list[str]:
    return [
        f"{_ORDER_ID} AS order_id",
        f"{customer} AS customer_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "CAST(CAST(l_quantity AS INT) AS STRING) AS quantity",
        f"{money(f'l_quantity * p_retailprice * {factor}')} AS total_amount",
        f"{date} AS order_date",
        f"{status} AS status",
        "row_id",
    ]


def base_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders without seeded defects, with the seeding keys kept."""
    columns = _raw_order_columns(_CUSTOMER, "1.0D", _SHIP_DAY, _STATUS)
    return _lines(spark, sf_dir).selectExpr(*columns, *SEED_KEYS)


def raw_orders(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Raw orders with about 5% of each seeded defect; ``dealt`` by their product where products are joined next."""
    tags = ("null", "ghost", "neg", "math", "future", "baddate", "typo")
    seeded = {f"_{tag}": selected_sql(tag, SEED_KEYS, SEED_SHARE) for tag in tags}
    columns = _raw_order_columns(
        f"CASE WHEN _null THEN NULL WHEN _ghost THEN concat('ghost-', {_CUSTOMER}) ELSE {_CUSTOMER} END",
        "(IF(_neg, -1.0D, 1.0D) * IF(_math, 1.5D, 1.0D))",
        f"CASE WHEN _future THEN '{FUTURE_TEXT}' WHEN _baddate THEN '{BAD_DATE_TEXT}' ELSE {_SHIP_DAY} END",
        f"CASE WHEN _typo THEN {_TYPO} ELSE {_STATUS} END",
    )
    return _lines(spark, sf_dir, dealt, **seeded).selectExpr(*columns)


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the order ids, from two columns of ``lineitem``: enough to find hot ids."""
    return table(spark, sf_dir, "lineitem").selectExpr(f"{_ORDER_ID} AS order_id")


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the batch dates of ``base_orders``."""
    return table(spark, sf_dir, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS batch_date")


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw orders with the batch date each belongs to."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS order_id",
        "CAST(user_id AS STRING) AS customer_id",
        "CAST(NULL AS STRING) AS product_id",
        "'1' AS quantity",
        f"{money('value')} AS total_amount",
        "CAST(CAST(ts AS DATE) AS STRING) AS order_date",
        "event_type AS status",
        "CAST(ts AS DATE) AS batch_date",
    )
