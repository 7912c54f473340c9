"""Every operator as a query over the test tables, next to its DuckDB counterpart.

The queries cover whole tables.  Dates leave as ISO text and sums rounded, so that
two engines print the same value; the operators themselves do neither.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustline.functions import casts, flags
from trustline.operators import calendar, dashboard, defects, mart, monitors, quality, rollup
from trustline.operators import duplicates as dup
from trustline.operators import staging as st
from trustline.operators.ranking import row_number_within
from trustline.plans import oracle as o
from trustline.sources import testdata as td
from trustline.sources.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS
from trustline.sources.tables import materialise, row_identity, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_AT = dt.datetime(2001, 6, 30, 12, 0, 0)
STAGED = ["order_id", "customer_id", "product_id", "quantity", "total_amount", "order_date", "status"]


class Tables:
    """Lazily built frames of the pipeline over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_orders(self) -> DataFrame:
        return td.raw_orders(self.spark, self.sf_dir)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return td.raw_customers(self.spark, self.sf_dir)

    @cached_property
    def raw_products(self) -> DataFrame:
        return td.raw_products(self.spark, self.sf_dir)

    @cached_property
    def order_ids(self) -> DataFrame:
        """The order ids alone, from the two key columns of ``lineitem``."""
        return td.order_ids(self.spark, self.sf_dir)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return st.stg_orders(self.raw_orders)

    @cached_property
    def dealt_orders(self) -> DataFrame:
        """The staged orders, dealt by product where they are made from the test tables."""
        return st.stg_orders(td.raw_orders(self.spark, self.sf_dir, dealt=True))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return st.stg_customers(self.raw_customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return st.stg_products(self.raw_products)

    @cached_property
    def hot(self) -> DataFrame:
        return dup.hot_buckets(self.order_ids, "order_id")

    @cached_property
    def hot_days(self) -> DataFrame:
        """Hot batch dates, counted on one column of ``lineitem``."""
        return dup.hot_buckets(td.ship_days(self.spark, self.sf_dir), "batch_date")

    @cached_property
    def fct(self) -> DataFrame:
        return mart.fct_orders(self.dealt_orders, self.stg_customers, self.stg_products, td.AS_OF, self.hot)

    @cached_property
    def feed(self) -> DataFrame:
        return rollup.daily_status_rollup(self.fct)

    @cached_property
    def models(self) -> dict[str, DataFrame]:
        return {
            "stg_orders": self.stg_orders,
            "stg_customers": self.stg_customers,
            "stg_products": self.stg_products,
            "fct_orders": self.fct,
        }

    @cached_property
    def results(self) -> DataFrame:
        return quality.run_tests(self.models, run_at=RUN_AT)

    @cached_property
    def base_orders(self) -> DataFrame:
        return td.base_orders(self.spark, self.sf_dir)

    @cached_property
    def base(self) -> DataFrame:
        """Staged orders without defects; their batch is their order date."""
        return st.stg_orders(self.base_orders).withColumn("batch_date", F.col("order_date"))

    @cached_property
    def events(self) -> DataFrame:
        return td.event_orders(self.spark, self.sf_dir)

    def stored(self, root: str, files: int) -> Tables:
        """The same tables read back from Parquet under ``root``, as a load would leave them.

        Daily loads leave many order files; ``files`` of them here.
        """
        for name in ("raw_orders", "base_orders"):
            rows = getattr(self, name).drop("row_id").repartition(files)
            rows.write.mode("overwrite").parquet(f"{root}/{name}")
        self.raw_customers.write.mode("overwrite").parquet(f"{root}/raw_customers")
        self.raw_products.write.mode("overwrite").parquet(f"{root}/raw_products")
        out = Tables(self.spark, self.sf_dir)
        orders = self.spark.read.schema(RAW_ORDERS).parquet(f"{root}/raw_orders")
        out.raw_orders = orders.select(*RAW_ORDERS.names, row_identity())
        out.dealt_orders = out.stg_orders
        out.order_ids = orders.select("order_id")
        base = self.spark.read.parquet(f"{root}/base_orders")
        out.base_orders = base.select("*", row_identity())
        out.raw_customers = self.spark.read.schema(RAW_CUSTOMERS).parquet(f"{root}/raw_customers")
        out.raw_products = self.spark.read.schema(RAW_PRODUCTS).parquet(f"{root}/raw_products")
        return out

    def one_test(self, name: str) -> DataFrame:
        spec = [t for t in quality.ORDER_TESTS if t.name == name]
        return quality.run_tests(self.models, spec, RUN_AT).select("test_name", "failures")


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    temporal = (T.DateType, T.TimestampType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, temporal) else f.name
            for f in df.schema
        ]
    )


def money(name: str, digits: int = 2) -> Column:
    return F.round(name, digits).alias(name)


def rounded(df: DataFrame, digits: int = 2) -> DataFrame:
    """All DOUBLE columns rounded."""
    return df.select(
        *[money(f.name, digits) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema]
    )


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with its counterpart."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        BUILDERS[name] = lambda tables: portable(build(tables))
        QUERIES[name] = lambda spark, sf_dir: BUILDERS[name](Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = o.with_prelude(sql)
        return build

    return register


# --- raw tables -----------------------------------------------------------------------

query(
    "raw_orders_scan",
    "SELECT order_id, customer_id, product_id, quantity, total_amount, order_date, status FROM raw_orders",
)(lambda t: t.raw_orders.select(*STAGED))

query("raw_customers_scan", "SELECT customer_id, name, email, signup_date, region FROM raw_customers")(
    lambda t: t.raw_customers
)

query("raw_products_scan", "SELECT product_id, category, price, stock_level, product_name FROM raw_products")(
    lambda t: t.raw_products
)


@query(
    "null_marker_normalise",
    """
    SELECT order_id, quantity, CASE WHEN note NOT IN ('NULL', 'null', '') THEN note END AS note
    FROM (SELECT order_id, quantity, CASE CAST(quantity AS INTEGER) % 5 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null'
                 WHEN 2 THEN '' WHEN 3 THEN 'Null' ELSE status END AS note FROM raw_orders)
    """,
)
def _null_markers(t: Tables) -> DataFrame:
    kind = F.col("quantity").cast("int") % 5
    note = (
        F.when(kind == 0, "NULL").when(kind == 1, "null").when(kind == 2, "").when(kind == 3, "Null")
    ).otherwise(F.col("status"))
    marked = t.raw_orders.select("order_id", "quantity", note.alias("note"))
    return casts.normalise_null_markers(marked, ["note"])


_EDGES = [
    "'2.49999999999'", "concat({q}, '.5')", "concat('-', {q}, '.5')", "'NaN'", "'-Infinity'", "'1e400'", "'1.5d'",
    "concat(' ', {q}, ' ')", "''", "'99999999999'", "concat('+', {q}, '.')", "'.5'", "concat({q}, 'x')", "'1e3'",
    "'2147483647.5'", "'0x1F'", "concat('-.', {q})", "'2024-02-30'", "'2024-1-5'", "concat('2024-01-', {q})",
]
_EDGE = " ".join(f"WHEN {i} THEN {text.format(q='q')}" for i, text in enumerate(_EDGES))
_EDGE_TEXT = f"CASE (l_orderkey + l_linenumber) % {len(_EDGES) + 1} {_EDGE} END"
_PLAIN_NUMBER = r"regexp_full_match(trim(note), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"


@query(
    "cast_edges",
    f"""
    SELECT l_orderkey, note,
           CASE WHEN {_PLAIN_NUMBER} AND abs(TRY_CAST(note AS DOUBLE)) < 1e18
                THEN TRY_CAST(round(CAST(trim(note) AS DECIMAL(38,15))) AS INTEGER) END AS as_int,
           CASE WHEN {_PLAIN_NUMBER} AND isfinite(TRY_CAST(note AS DOUBLE)) THEN TRY_CAST(note AS DOUBLE) END AS as_double,
           CASE WHEN regexp_full_match(note, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
                THEN CAST(TRY_CAST(note AS DATE) AS VARCHAR) END AS as_date
    FROM (SELECT l_orderkey, {_EDGE_TEXT} AS note FROM (SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q FROM lineitem))
    """,
)
def _cast_edges(t: Tables) -> DataFrame:
    """Texts that a cast may get wrong, made from the quantities of all order lines."""
    lines = t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet").selectExpr("*", "CAST(CAST(l_quantity AS INT) AS STRING) AS q")
    note = F.col("note")
    return lines.selectExpr("l_orderkey", f"{_EDGE_TEXT} AS note").select(
        "l_orderkey", "note", casts.safe_int(note).alias("as_int"),
        casts.safe_double(note).alias("as_double"), casts.safe_date(note).alias("as_date"),
    )


@query(
    "load_row_counts",
    """
    SELECT 'Customers' AS table_name, count(*) AS cnt FROM raw_customers
    UNION ALL SELECT 'Products', count(*) FROM raw_products
    UNION ALL SELECT 'Orders', count(*) FROM raw_orders
    """,
)
def _load_row_counts(t: Tables) -> DataFrame:
    return monitors.load_row_counts(
        {
            "Customers": t.raw_customers,
            "Products": t.raw_products,
            "Orders": t.raw_orders,
        }
    )


# --- staging --------------------------------------------------------------------------

query(
    "stg_customers",
    "SELECT customer_id, name, email, region, CAST(signup_date AS VARCHAR) AS signup_date FROM stg_customers",
)(lambda t: t.stg_customers)

query("stg_products", "SELECT * FROM stg_products")(lambda t: t.stg_products)

query(
    "stg_orders",
    "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM stg_orders",
)(lambda t: t.stg_orders.select(*STAGED))


# --- mart, flags and joins ------------------------------------------------------------

query("fct_orders", "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM fct")(lambda t: t.fct)

for _name, _flag in [
    ("flag_orphan", "is_orphan_order"),
    ("flag_negative", "has_negative_amount"),
    ("flag_duplicate", "is_duplicate"),
    ("flag_future", "is_future_order"),
    ("flag_math_error", "has_math_error"),
    ("flag_bad_status", "has_bad_status"),
]:
    query(
        _name,
        f"SELECT order_id, product_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, {_flag} FROM fct",
    )(lambda t, flag=_flag: t.fct.select("order_id", "product_id", "customer_id", "order_date", flag))

_MARKED = """
    SELECT * EXCLUDE (dirty) REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM marked WHERE {0}"""
query("dirty_orders", _MARKED.format("dirty"))(lambda t: mart.dirty_orders(t.fct))
query("clean_orders", _MARKED.format("NOT dirty"))(lambda t: mart.clean_orders(t.fct))

query(
    "status_bucket",
    """
    SELECT order_id, product_id, status,
           CASE WHEN status IN ('COMPLETED', 'PENDING', 'SHIPPED', 'CANCELLED') THEN status
                ELSE 'INVALID/DIRTY' END AS status_group
    FROM stg_orders
    """,
)(
    lambda t: t.stg_orders.select(
        "order_id", "product_id", "status", flags.status_bucket(F.col("status")).alias("status_group")
    )
)

query(
    "orders_left_join_customers",
    """
    SELECT s.order_id, s.product_id, s.customer_id, c.name AS customer_name, c.region AS customer_region
    FROM stg_orders s LEFT JOIN stg_customers c ON s.customer_id = c.customer_id
    """,
)(
    lambda t: mart.join_customers(t.stg_orders, t.stg_customers).select(
        "order_id", "product_id", "customer_id", "customer_name", "customer_region"
    )
)

query(
    "orders_left_join_products",
    """
    SELECT s.order_id, s.customer_id, s.product_id, p.product_name, p.category, p.price AS unit_price
    FROM stg_orders s LEFT JOIN stg_products p ON s.product_id = p.product_id
    """,
)(
    lambda t: mart.join_products(t.stg_orders, t.stg_products).select(
        "order_id", "customer_id", "product_id", "product_name", "category", "unit_price"
    )
)

query(
    "derive_order_total",
    """
    SELECT b.order_id, b.product_id, b.quantity, p.price AS unit_price,
           round(p.price * b.quantity, 2) AS total_amount
    FROM base b JOIN stg_products p ON b.product_id = p.product_id
    """,
)(
    lambda t: mart.derive_order_total(
        t.base.select("order_id", "product_id", "quantity"), t.stg_products
    ).select("order_id", "product_id", "quantity", "unit_price", "total_amount")
)

query(
    "order_row_number",
    f"""
    SELECT o.order_id, o.product_id, o.customer_id, CAST(o.order_date AS VARCHAR) AS order_date,
           row_number() OVER (PARTITION BY o.order_id ORDER BY {o.FIRST_ROW}) AS row_number
    FROM stg_orders o
    """,
)(
    lambda t: mart.order_row_number(t.stg_orders, t.hot).select(
        "order_id", "product_id", "customer_id", "order_date", "row_number"
    )
)


# --- rollup and report tables ---------------------------------------------------------

FEED_SQL = """
    SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date, round(total_revenue, 2) AS total_revenue,
                      round(clean_revenue, 2) AS clean_revenue) FROM {0}"""

query("daily_status_rollup", FEED_SQL.format("feed"))(lambda t: rounded(t.feed))

query("lowercase_columns", FEED_SQL.format("feed"))(
    lambda t: casts.lowercase_columns(rounded(t.feed.toDF(*[c.upper() for c in t.feed.columns])))
)

query("business_view", FEED_SQL.format("business"))(
    lambda t: rounded(dashboard.business_view(t.feed, td.AS_OF))
)

query(
    "clean_revenue_by_date",
    """
    SELECT CAST(order_date AS VARCHAR) AS order_date,
           round(sum(CASE WHEN dirty THEN 0 ELSE total_amount END), 2) AS clean_revenue
    FROM marked GROUP BY order_date
    """,
)(lambda t: rounded(rollup.clean_revenue_by_date(t.fct)))

query(
    "defect_counts",
    """
    SELECT count(*) AS order_count,
           count(*) FILTER (WHERE is_orphan_order) AS orphan_orders,
           count(*) FILTER (WHERE has_negative_amount) AS negative_amount_orders,
           count(*) FILTER (WHERE is_duplicate) AS duplicate_orders,
           count(*) FILTER (WHERE is_future_order) AS future_orders,
           count(*) FILTER (WHERE has_math_error) AS math_errors,
           count(*) FILTER (WHERE has_bad_status) AS bad_status_orders
    FROM marked
    """,
)(lambda t: rollup.defect_counts(t.fct))

query("kpi_totals", "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM score")(
    lambda t: rounded(dashboard.kpis(t.feed))
)

query(
    "health_score",
    """
    SELECT total_orders, incidents, round(health_score, 4) AS health_score,
           round(100 - health_score, 4) AS shortfall FROM health
    """,
)(lambda t: rounded(dashboard.health_score(t.feed), 4))

query(
    "kpi_cards",
    """
    SELECT printf('%.1f%%', health_score) AS health_score,
           CASE WHEN health_score < 100 THEN printf('-%.1f%%', 100 - health_score) ELSE '0%' END AS health_delta,
           '$' || format('{:,.2f}', total_revenue) AS total_revenue,
           format('{:,}', total_orders) AS total_orders,
           CAST(incidents AS VARCHAR) AS incidents,
           CASE WHEN incidents > 0 THEN 'High Severity' ELSE 'Clean' END AS incident_delta
    FROM health
    """,
)(lambda t: dashboard.kpi_cards(t.feed))

query(
    "daily_revenue",
    """
    SELECT CAST(order_date AS VARCHAR) AS order_date, round(total_revenue, 2) AS total_revenue,
           round(clean_revenue, 2) AS clean_revenue FROM daily ORDER BY order_date
    """,
)(lambda t: rounded(dashboard.daily_revenue(t.feed, td.AS_OF)))

query(
    "daily_revenue_long",
    """
    SELECT CAST(order_date AS VARCHAR) AS order_date, 'total_revenue' AS "Metric",
           round(total_revenue, 2) AS "Amount" FROM daily
    UNION ALL
    SELECT CAST(order_date AS VARCHAR), 'clean_revenue', round(clean_revenue, 2) FROM daily
    """,
)(lambda t: rounded(dashboard.daily_revenue_long(t.feed, td.AS_OF)))

_RISK = """
    SELECT round(sum(total_revenue), 2) AS total_revenue, round(sum(clean_revenue), 2) AS clean_revenue,
           round(sum(total_revenue) - sum(clean_revenue), 2) AS revenue_at_risk FROM daily"""

query("revenue_at_risk", _RISK)(lambda t: rounded(dashboard.revenue_at_risk(t.feed, td.AS_OF)))

query(
    "risk_message",
    f"""
    SELECT 'Financial Risk Detected: $' || format('{{:,.2f}}', revenue_at_risk)
           || ' of reported revenue is compromised by data quality issues.' AS message FROM ({_RISK})
    """,
)(lambda t: dashboard.risk_message(t.feed, td.AS_OF))

query(
    "orders_by_status_bucket",
    """
    SELECT CASE WHEN status IN ('COMPLETED', 'PENDING', 'SHIPPED', 'CANCELLED') THEN status
                ELSE 'INVALID/DIRTY' END AS status_group, CAST(sum(order_count) AS BIGINT) AS order_count
    FROM feed GROUP BY 1 ORDER BY 1
    """,
)(lambda t: dashboard.status_buckets(t.feed))

query("issue_breakdown", "SELECT position, issue_type, issue_count, impact FROM issues")(
    lambda t: dashboard.issue_breakdown(t.feed)
)

query("issue_drilldown", "SELECT position, issue_type, message FROM issues WHERE issue_count > 0")(
    lambda t: dashboard.issue_drilldown(t.feed)
)


# --- quality tests --------------------------------------------------------------------

for _name, _test, _table in [
    ("test_unique_customer_id", "unique_stg_customers_customer_id", "t_unique_customer"),
    ("test_unique_product_id", "unique_stg_products_product_id", "t_unique_product"),
    ("test_unique_order_id", "unique_stg_orders_order_id", "t_unique_order"),
    ("test_unique_fct_order_id", "unique_fct_orders_order_id", "t_unique_fct"),
    ("test_relationships", "relationships_fct_orders_customer_id", "t_relationships"),
    ("test_between_total_amount", "between_fct_orders_total_amount", "t_between"),
]:
    query(_name, f"SELECT test_name, failures FROM {_table}")(lambda t, test=_test: t.one_test(test))


@query("test_not_null_all", "SELECT test_name, failures FROM t_not_null")
def _not_null(t: Tables) -> DataFrame:
    specs = [s for s in quality.ORDER_TESTS if isinstance(s, quality.NotNull)]
    return quality.run_tests(t.models, specs, RUN_AT).select("test_name", "failures")


query(
    "duplicate_keys",
    """
    SELECT order_id, count(*) AS row_count FROM stg_orders WHERE order_id IS NOT NULL
    GROUP BY order_id HAVING count(*) > 1
    """,
)(lambda t: quality.duplicate_keys(t.stg_orders, "order_id"))

query("dq_results", "SELECT test_name, model, column_name, failures, severity, status FROM results")(
    lambda t: t.results.drop("generated_at")
)

query(
    "dq_failure_summary",
    """
    SELECT '2001-06-30 12:00:00' AS test_run_time, count(*) AS total_failures
    FROM results WHERE status IN ('fail', 'warn')
    """,
)(lambda t: quality.dq_failure_summary(t.results))

_REASONS = [f"CASE WHEN {f} THEN '{f}' END" for f in flags.FLAGS]

query(
    "quarantine_rows",
    f"""
    SELECT * EXCLUDE (dirty) REPLACE (CAST(order_date AS VARCHAR) AS order_date),
           concat_ws(',', {", ".join(_REASONS)}) AS reasons
    FROM marked WHERE dirty
    """,
)(lambda t: quality.quarantine_rows(t.fct).withColumn("reasons", F.concat_ws(",", "reasons")))

query(
    "quarantine_by_reason",
    " UNION ALL ".join(
        f"SELECT '{f}' AS reason, count(*) AS row_count, round(sum(total_amount), 2) AS amount FROM fct WHERE {f}"
        for f in flags.FLAGS
    ),
)(lambda t: rounded(quality.quarantine_by_reason(t.fct)))

query(
    "freshness",
    f"""
    SELECT 'stg_orders' AS table_name, CAST(max(order_date) AS VARCHAR) AS latest_date,
           CAST({o.AS_OF} - max(order_date) AS INTEGER) AS days_old
    FROM stg_orders WHERE order_date <= {o.AS_OF}
    UNION ALL
    SELECT 'stg_customers', CAST(max(signup_date) AS VARCHAR), CAST({o.AS_OF} - max(signup_date) AS INTEGER)
    FROM stg_customers WHERE signup_date <= {o.AS_OF}
    """,
)(
    lambda t: monitors.freshness(
        {
            "stg_orders": (t.stg_orders, "order_date"),
            "stg_customers": (t.stg_customers, "signup_date"),
        },
        td.AS_OF,
    )
)

query(
    "volume_anomaly",
    f"""
    SELECT CAST(order_date AS VARCHAR) AS order_date, row_count, round(expected, 4) AS expected,
           round(spread, 4) AS spread, round(z, 4) AS z_score, coalesce(abs(z) > 3, FALSE) AS is_anomaly
    FROM (
      SELECT *, CASE WHEN spread > 0 THEN (row_count - expected) / spread END AS z
      FROM (
        SELECT order_date, row_count,
               CASE WHEN count(*) OVER w = 14 THEN avg(row_count) OVER w END AS expected,
               CASE WHEN count(*) OVER w = 14 THEN stddev_samp(row_count) OVER w END AS spread
        FROM (SELECT order_date, coalesce(n, 0) AS row_count
              FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date
                    FROM stg_orders WHERE order_date <= {o.AS_OF})
              LEFT JOIN (SELECT order_date, count(*) AS n FROM stg_orders GROUP BY order_date) USING (order_date))
        WINDOW w AS (ORDER BY order_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)
      )
    )
    """,
)(lambda t: rounded(monitors.volume_anomaly(t.stg_orders, as_of=td.AS_OF), 4))


# --- defect seeding -------------------------------------------------------------------

_SEEDED = {
    "customer_id": "customer_id",
    "total_amount": "round(total_amount, 2)",
    "order_date": "CAST(order_date AS VARCHAR)",
    "status": "status",
}


def _seeded_sql(**changes: str) -> str:
    columns = ", ".join(f"{changes.get(c, expr)} AS {c}" for c, expr in _SEEDED.items())
    return f"SELECT order_id, product_id, quantity, {columns}"


def _seeded(df: DataFrame) -> DataFrame:
    return rounded(df.select("order_id", "product_id", "quantity", *_SEEDED))


for _name, _tag, _changes in [
    (
        "seed_ghost_customer",
        "ghost",
        {"customer_id": f"CASE WHEN {o.hit('ghost')} THEN concat('ghost-', customer_id) ELSE customer_id END"},
    ),
    (
        "seed_null_customer",
        "null",
        {"customer_id": f"CASE WHEN NOT {o.hit('null')} THEN customer_id END"},
    ),
    (
        "seed_negative",
        "neg",
        {"total_amount": f"round(CASE WHEN {o.hit('neg')} THEN total_amount * -1 ELSE total_amount END, 2)"},
    ),
    (
        "seed_math_error",
        "math",
        {
            "total_amount": f"round(CASE WHEN {o.hit('math')} THEN total_amount * 1.5::DOUBLE "
            "ELSE total_amount END, 2)"
        },
    ),
    (
        "seed_future_date",
        "future",
        {
            "order_date": f"CAST(CASE WHEN {o.hit('future')} THEN CAST({o.AS_OF} + 10000 AS DATE) "
            "ELSE order_date END AS VARCHAR)"
        },
    ),
    (
        "seed_status_typo",
        "typo",
        {
            "status": f"CASE WHEN {o.hit('typo')} THEN {o.TYPO_LIST}"
            f"[{o.hash_number("concat('typo-pick|', row_key)")} % 5 + 1] ELSE status END"
        },
    ),
]:
    query(_name, _seeded_sql(**_changes) + " FROM base")(
        lambda t, tag=_tag: _seeded(defects.seed_defects(t.base, td.SEED_KEYS, tags=[tag], as_of=td.AS_OF))
    )

query(
    "seed_duplicates",
    _seeded_sql()
    + f""" FROM (
      SELECT * FROM base
      UNION ALL
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY batch_date ORDER BY md5(concat('copy|', row_key))) AS rn
        FROM base)
      WHERE rn <= {o.hash_number("concat('copies|', CAST(batch_date AS VARCHAR))")} % 6)""",
)(lambda t: _seeded(defects.seed_duplicates(t.base, td.SEED_KEYS, "batch_date")))

query(
    "seed_exact_per_batch",
    _seeded_sql(total_amount="round(CASE WHEN rn <= draw THEN total_amount * -1 ELSE total_amount END, 2)")
    + f""" FROM (
      SELECT *, row_number() OVER (PARTITION BY batch_date ORDER BY md5(concat('neg|', row_key))) AS rn,
             {o.hash_number("concat('neg|', CAST(batch_date AS VARCHAR))")}
               % (CAST(floor(count(*) OVER (PARTITION BY batch_date) * 0.1::DOUBLE) AS BIGINT) + 1) AS draw
      FROM base)""",
)(
    lambda t: _seeded(
        defects.seed_exact(t.base, "neg", td.SEED_KEYS, "batch_date", hot=t.hot_days, as_of=td.AS_OF)
    )
)

# --- hot keys -------------------------------------------------------------------------
# The same operators with a threshold so low that the keys count as hot.

_LINES = "SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 7) AS line, CAST(l_shipdate AS DATE) AS shipped FROM lineitem"
_LINE_ORDER = dup.Ordering(("shipped", "l_orderkey", "l_linenumber"))
_LINE_NUMBER = f"row_number() OVER (PARTITION BY line ORDER BY shipped NULLS LAST, l_orderkey, l_linenumber) AS n FROM ({_LINES})"


def _lines(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order lines by an INT key of seven values, one of them NULL, and its hot buckets."""
    number = F.col("l_linenumber").cast("int")
    lines = t.spark.read.parquet(f"{t.sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").cast("long").alias("l_orderkey"),
        number.alias("l_linenumber"),
        F.nullif(number, F.lit(7)).alias("line"),
        F.col("l_shipdate").cast("date").alias("shipped"),
        row_identity(),
    )
    return lines, dup.hot_buckets(lines.select("line"), "line", min_rows=100)


@query(
    "hot_row_number",
    f"SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(line AS INTEGER) AS line, {_LINE_NUMBER}",
)
def _hot_row_number(t: Tables) -> DataFrame:
    lines, hot = _lines(t)
    numbered = row_number_within(lines, "line", _LINE_ORDER, "n", hot)
    return numbered.select("l_orderkey", "l_linenumber", "line", F.col("n").cast("bigint").alias("n"))


@query(
    "hot_flag_duplicate",
    f"SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(line AS INTEGER) AS line, n > 1 AS again FROM (SELECT *, {_LINE_NUMBER})",
)
def _hot_flags(t: Tables) -> DataFrame:
    lines, hot = _lines(t)
    return dup.flag_repeats(lines, "line", _LINE_ORDER, "again", hot).select("l_orderkey", "l_linenumber", "line", "again")


BUILDERS["hot_seed_exact"] = lambda t: portable(
    _seeded(
        defects.seed_exact(
            # Read three times, so its joins are made once.
            materialise(t.base, f"{scratch_folder(t.spark, 'seed')}/base"), "neg", td.SEED_KEYS, "batch_date",
            hot=dup.hot_buckets(td.ship_days(t.spark, t.sf_dir), "batch_date", min_rows=5), as_of=td.AS_OF,
        )
    )
)
BUILDERS["hot_fct_orders"] = lambda t: portable(
    mart.fct_orders(t.dealt_orders, t.stg_customers, t.stg_products, td.AS_OF, dup.hot_buckets(t.order_ids, "order_id", min_rows=1))
)
for _hot, _plain in (("hot_seed_exact", "seed_exact_per_batch"), ("hot_fct_orders", "fct_orders")):
    QUERIES[_hot] = lambda spark, sf_dir, name=_hot: BUILDERS[name](Tables(spark, sf_dir))
    ORACLES[_hot] = ORACLES[_plain]


query(
    "detector_recall",
    " UNION ALL ".join(
        f"""
    SELECT '{tag}' AS defect, '{flag}' AS flag, count(*) FILTER (WHERE seeded_{tag}) AS seeded,
           count(*) FILTER (WHERE seeded_{tag} AND {flag}) AS detected,
           round(count(*) FILTER (WHERE seeded_{tag} AND {flag})::DOUBLE
                 / nullif(count(*) FILTER (WHERE seeded_{tag}), 0), 4) AS recall
    FROM recall_rows"""
        for tag, flag in defects.DETECTED_BY.items()
    ),
)(
    lambda t: rounded(
        defects.detector_recall(
            defects.seed_all(t.base, td.SEED_KEYS, "batch_date", as_of=td.AS_OF, markers=True),
            t.stg_customers,
            t.stg_products,
            td.AS_OF,
            t.hot,
        ),
        4,
    )
)


# --- date window ----------------------------------------------------------------------

query(
    "rows_per_batch",
    "SELECT CAST(batch_date AS VARCHAR) AS batch_date, count(*) AS row_count FROM event_orders GROUP BY batch_date",
)(lambda t: monitors.rows_per_batch(t.events))

query(
    "high_water_mark",
    f"""
    SELECT CAST(coalesce(max(batch_date), CAST({o.EVENTS_AS_OF} - 1 AS DATE)) AS VARCHAR) AS high_water
    FROM event_orders
    """,
)(lambda t: calendar.high_water_mark(t.events, as_of=td.EVENTS_AS_OF))

query(
    "incremental_window",
    f"""
    SELECT CAST(CAST(max(batch_date) + 1 AS DATE) AS VARCHAR) AS start_date,
           CAST({o.EVENTS_AS_OF} AS VARCHAR) AS end_date,
           CAST(greatest({o.EVENTS_AS_OF} - max(batch_date), 0) AS INTEGER) AS day_count
    FROM event_orders
    """,
)(
    lambda t: calendar.incremental_window(
        calendar.high_water_mark(t.events, as_of=td.EVENTS_AS_OF), td.EVENTS_AS_OF
    )
)

_SPINE = f"""
    SELECT CAST(unnest(generate_series(min(batch_date), {o.EVENTS_AS_OF}, INTERVAL 1 DAY)) AS DATE) AS day
    FROM event_orders"""

query("date_spine", f"SELECT CAST(day AS VARCHAR) AS day FROM ({_SPINE})")(
    lambda t: calendar.days_of(calendar.span(t.events, "batch_date", td.EVENTS_AS_OF))
)

query(
    "missing_days",
    f"""
    SELECT CAST(day AS VARCHAR) AS day FROM ({_SPINE})
    WHERE day NOT IN (SELECT batch_date FROM event_orders)
    """,
)(
    lambda t: calendar.missing_days(
        calendar.days_of(calendar.span(t.events, "batch_date", td.EVENTS_AS_OF)), t.events
    )
)
