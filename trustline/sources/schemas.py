"""Fixed schemas of the raw, staging, mart and rollup tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _DATE, _BOOL = T.DoubleType(), T.DateType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# Raw tables are all text, so that loading never fails on a type; order is file order.
RAW_CUSTOMERS = _schema(customer_id=_TEXT, name=_TEXT, email=_TEXT, signup_date=_TEXT, region=_TEXT)
RAW_PRODUCTS = _schema(
    product_id=_TEXT, category=_TEXT, price=_TEXT, stock_level=_TEXT, product_name=_TEXT
)
RAW_ORDERS = _schema(
    order_id=_TEXT,
    customer_id=_TEXT,
    product_id=_TEXT,
    quantity=_TEXT,
    total_amount=_TEXT,
    order_date=_TEXT,
    status=_TEXT,
)
RAW = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders": RAW_ORDERS}

STG_CUSTOMERS = _schema(customer_id=_TEXT, name=_TEXT, email=_TEXT, region=_TEXT, signup_date=_DATE)
STG_PRODUCTS = _schema(
    product_id=_TEXT, product_name=_TEXT, category=_TEXT, price=_DOUBLE, stock_level=_INT
)
STG_ORDERS = _schema(
    order_id=_TEXT,
    customer_id=_TEXT,
    product_id=_TEXT,
    quantity=_INT,
    total_amount=_DOUBLE,
    order_date=_DATE,
    status=_TEXT,
)

FCT_ORDERS = _schema(
    order_id=_TEXT,
    customer_id=_TEXT,
    product_id=_TEXT,
    order_date=_DATE,
    status=_TEXT,
    quantity=_INT,
    total_amount=_DOUBLE,
    customer_name=_TEXT,
    customer_region=_TEXT,
    product_name=_TEXT,
    category=_TEXT,
    unit_price=_DOUBLE,
    is_orphan_order=_BOOL,
    has_negative_amount=_BOOL,
    is_duplicate=_BOOL,
    is_future_order=_BOOL,
    has_math_error=_BOOL,
    has_bad_status=_BOOL,
)

FEED = _schema(
    order_date=_DATE,
    status=_TEXT,
    order_count=_LONG,
    total_revenue=_DOUBLE,
    clean_revenue=_DOUBLE,
    orphan_orders=_LONG,
    negative_amount_orders=_LONG,
    duplicate_orders=_LONG,
    future_orders=_LONG,
    math_errors=_LONG,
    bad_status_orders=_LONG,
)

DQ_RESULTS = _schema(
    test_name=_TEXT,
    model=_TEXT,
    column_name=_TEXT,
    failures=_LONG,
    severity=_TEXT,
    status=_TEXT,
    generated_at=T.TimestampType(),
)
