"""SQL text shared by the DuckDB counterparts of the catalogue queries.

It states the same definitions once more in plain SQL, straight on the test tables,
so that a query and its counterpart have no code in common.
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-30'"
EVENTS_AS_OF = "DATE '2024-02-05'"


def hit(tag: str) -> str:
    return f"substr(md5(concat('{tag}|', row_key)), 1, 15) < '{int(0.05 * 16**15):015x}'"


def hash_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _int(c: str) -> str:
    return f"TRY_CAST(round(TRY_CAST({c} AS DECIMAL(38,10)), 0) AS INTEGER)"


def _date(c: str) -> str:
    return f"CASE WHEN length({c}) = 10 THEN TRY_CAST({c} AS DATE) END"


def _money(c: str) -> str:
    return f"CAST(CAST(round({c}, 2) AS DECIMAL(18,2)) AS VARCHAR)"


# Column names, valid statuses, typo list and issue labels of the outputs that
# the queries have to match.
_CLEAN_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'SHIPPED' END"
TYPO_LIST = "['Completado', 'completed', 'Shipped!', 'Pending...', 'Cancelled (User)']"

_RAW = f"""
lines AS (
  SELECT *, concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS row_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
base_orders AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         {_money("l_quantity * p_retailprice")} AS total_amount,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS order_date,
         {_CLEAN_STATUS} AS status,
         row_key
  FROM lines
),
raw_orders AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS order_id,
         CASE WHEN {hit("null")} THEN NULL
              WHEN {hit("ghost")} THEN concat('ghost-', o_custkey)
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         {_money(f"l_quantity * p_retailprice * ((CASE WHEN {hit('neg')} THEN -1.0 ELSE 1.0 END)::DOUBLE * (CASE WHEN {hit('math')} THEN 1.5 ELSE 1.0 END)::DOUBLE)")} AS total_amount,
         CASE WHEN {hit("future")} THEN '2030-01-01'
              WHEN {hit("baddate")} THEN 'not-a-date'
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS order_date,
         CASE WHEN {hit("typo")} THEN {TYPO_LIST}[l_linenumber % 5 + 1] ELSE {_CLEAN_STATUS} END AS status
  FROM lines
),
raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         concat(lower(replace(c_name, '#', '')), '@example.com') AS email,
         CAST(CAST(DATE '1995-01-01' + CAST(c_custkey % 730 AS INTEGER) AS DATE) AS VARCHAR) AS signup_date,
         r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category,
         {_money("p_retailprice")} AS price, CAST(p_size AS VARCHAR) AS stock_level, p_name AS product_name
  FROM part
),
event_orders AS (SELECT event_id, CAST(ts AS DATE) AS batch_date FROM events)"""


def _staged(source: str, extra: str = "") -> str:
    return f"""
  SELECT order_id, customer_id, product_id, {_int("quantity")} AS quantity,
         TRY_CAST(total_amount AS DOUBLE) AS total_amount, {_date("order_date")} AS order_date,
         upper(status) AS status{extra}
  FROM {source}"""


_STAGING = f"""
stg_customers AS (
  SELECT customer_id, name, email, region, {_date("signup_date")} AS signup_date FROM raw_customers
),
stg_products AS (
  SELECT product_id, product_name, category, TRY_CAST(price AS DOUBLE) AS price,
         {_int("stock_level")} AS stock_level
  FROM raw_products
),
stg_orders AS ({_staged("raw_orders")}
),
base AS ({_staged("base_orders", ", row_key, " + _date("order_date") + " AS batch_date")}
)"""

FIRST_ROW = (
    "o.order_date ASC NULLS LAST, o.product_id ASC NULLS LAST, o.total_amount ASC NULLS LAST, "
    "o.customer_id ASC NULLS LAST, o.status ASC NULLS LAST"
)


def flags(source: str, extra: str = "", ties: str = "") -> str:
    """The mart over an order relation with staging columns."""
    return f"""
  SELECT o.order_id, o.customer_id, o.product_id, o.order_date, o.status, o.quantity, o.total_amount,
         c.name AS customer_name, c.region AS customer_region, p.product_name, p.category,
         p.price AS unit_price,
         c.customer_id IS NULL AS is_orphan_order,
         coalesce(o.total_amount < 0, FALSE) AS has_negative_amount,
         row_number() OVER (PARTITION BY o.order_id ORDER BY {FIRST_ROW}{ties}) > 1 AS is_duplicate,
         coalesce(o.order_date > {AS_OF}, FALSE) AS is_future_order,
         coalesce(abs(o.total_amount - o.quantity * p.price) > 0.05::DOUBLE, FALSE) AS has_math_error,
         o.status IS NULL OR o.status NOT IN ('COMPLETED', 'PENDING', 'SHIPPED', 'CANCELLED')
           AS has_bad_status{extra}
  FROM {source} o
  LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN stg_products p ON o.product_id = p.product_id"""


_MART = f"""
fct AS ({flags("stg_orders")}
),
marked AS (
  SELECT *, is_orphan_order OR has_negative_amount OR is_duplicate OR is_future_order
            OR has_math_error OR has_bad_status AS dirty
  FROM fct
),
feed AS (
  SELECT order_date, status, count(*) AS order_count, sum(total_amount) AS total_revenue,
         sum(CASE WHEN dirty THEN 0 ELSE total_amount END) AS clean_revenue,
         count(*) FILTER (WHERE is_orphan_order) AS orphan_orders,
         count(*) FILTER (WHERE has_negative_amount) AS negative_amount_orders,
         count(*) FILTER (WHERE is_duplicate) AS duplicate_orders,
         count(*) FILTER (WHERE is_future_order) AS future_orders,
         count(*) FILTER (WHERE has_math_error) AS math_errors,
         count(*) FILTER (WHERE has_bad_status) AS bad_status_orders
  FROM marked GROUP BY order_date, status
),
business AS (SELECT * FROM feed WHERE order_date <= {AS_OF}),
kpi AS (
  SELECT CAST(coalesce(sum(order_count), 0) AS BIGINT) AS total_orders,
         coalesce(sum(total_revenue), 0) AS total_revenue,
         CAST(coalesce(sum(orphan_orders), 0) AS BIGINT) AS orphan_orders,
         CAST(coalesce(sum(negative_amount_orders), 0) AS BIGINT) AS negative_amount_orders,
         CAST(coalesce(sum(duplicate_orders), 0) AS BIGINT) AS duplicate_orders,
         CAST(coalesce(sum(future_orders), 0) AS BIGINT) AS future_orders,
         CAST(coalesce(sum(math_errors), 0) AS BIGINT) AS math_errors,
         CAST(coalesce(sum(bad_status_orders), 0) AS BIGINT) AS bad_status_orders
  FROM feed
),
score AS (
  SELECT *, orphan_orders + negative_amount_orders + duplicate_orders + future_orders
            + math_errors + bad_status_orders AS incidents
  FROM kpi
),
health AS (
  SELECT *, CASE WHEN total_orders > 0
                 THEN greatest(0.0::DOUBLE, 100 - incidents::DOUBLE / total_orders * 100)
                 ELSE 100.0::DOUBLE END AS health_score
  FROM score
),
daily AS (
  SELECT order_date, coalesce(sum(total_revenue), 0) AS total_revenue,
         coalesce(sum(clean_revenue), 0) AS clean_revenue
  FROM business GROUP BY order_date
),
issues AS (
  SELECT 1 AS position, 'Orphan Orders (FK Failure)' AS issue_type, orphan_orders AS issue_count,
         'High' AS impact,
         printf('Found %d orders referencing non-existent customers (Referential Integrity).', orphan_orders)
           AS message FROM kpi
  UNION ALL
  SELECT 2, 'Negative Amounts (Domain Error)', negative_amount_orders, 'High',
         printf('Found %d orders with negative total amounts (Domain Error).', negative_amount_orders) FROM kpi
  UNION ALL
  SELECT 3, 'Duplicate Orders (Uniqueness)', duplicate_orders, 'Critical',
         printf('Found %d duplicate orders (Uniqueness Violation).', duplicate_orders) FROM kpi
  UNION ALL
  SELECT 4, 'Future Dates (Temporal Validity)', future_orders, 'Medium',
         printf('Found %d orders with future dates (Time Travel / Temporal Validity).', future_orders) FROM kpi
  UNION ALL
  SELECT 5, 'Math Mismatch (Calculation Integrity)', math_errors, 'Medium',
         printf('Found %d orders where Total != Price * Qty (Calculation Integrity).', math_errors) FROM kpi
  UNION ALL
  SELECT 6, 'Invalid Status (String Inconsistency)', bad_status_orders, 'Low',
         printf('Found %d orders with invalid status strings (Consistency / Dirty Data).', bad_status_orders)
  FROM kpi
)"""


def _unique(name: str, table: str, column: str) -> str:
    return f"""SELECT '{name}' AS test_name, count(*) AS failures FROM
    (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""


def _not_null(name: str, table: str, column: str) -> str:
    return f"SELECT '{name}' AS test_name, count(*) FILTER (WHERE {column} IS NULL) AS failures FROM {table}"


_TESTS = f"""
t_unique_customer AS ({_unique("unique_stg_customers_customer_id", "stg_customers", "customer_id")}),
t_unique_product AS ({_unique("unique_stg_products_product_id", "stg_products", "product_id")}),
t_unique_order AS ({_unique("unique_stg_orders_order_id", "stg_orders", "order_id")}),
t_unique_fct AS ({_unique("unique_fct_orders_order_id", "fct", "order_id")}),
t_not_null AS (
  {_not_null("not_null_stg_customers_customer_id", "stg_customers", "customer_id")}
  UNION ALL {_not_null("not_null_stg_products_product_id", "stg_products", "product_id")}
  UNION ALL {_not_null("not_null_stg_orders_order_id", "stg_orders", "order_id")}
  UNION ALL {_not_null("not_null_fct_orders_order_id", "fct", "order_id")}
),
t_relationships AS (
  SELECT 'relationships_fct_orders_customer_id' AS test_name, count(*) AS failures
  FROM fct f WHERE f.customer_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = f.customer_id)
),
t_between AS (
  SELECT 'between_fct_orders_total_amount' AS test_name,
         count(*) FILTER (WHERE total_amount < 0) AS failures FROM fct
),
results AS (
  SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
  FROM (
    SELECT test_name, 'stg_customers' AS model, 'customer_id' AS column_name, failures, 'error' AS severity
    FROM t_unique_customer
    UNION ALL SELECT test_name, 'stg_products', 'product_id', failures, 'error' FROM t_unique_product
    UNION ALL SELECT test_name, 'stg_orders', 'order_id', failures, 'warn' FROM t_unique_order
    UNION ALL SELECT test_name, 'fct_orders', 'order_id', failures, 'warn' FROM t_unique_fct
    UNION ALL SELECT test_name, regexp_extract(test_name, '^not_null_(.*)_(customer|product|order)_id$', 1),
                     regexp_extract(test_name, '((customer|product|order)_id)$', 1), failures, 'error'
              FROM t_not_null
    UNION ALL SELECT test_name, 'fct_orders', 'customer_id', failures, 'warn' FROM t_relationships
    UNION ALL SELECT test_name, 'fct_orders', 'total_amount', failures, 'warn' FROM t_between
  )
)"""

_SEEDED_SIX = f"""
hits AS (
  SELECT *, {hit("ghost")} AS seeded_ghost, {hit("null")} AS seeded_null, {hit("neg")} AS seeded_neg,
         {hit("math")} AS seeded_math, {hit("future")} AS seeded_future, {hit("typo")} AS seeded_typo,
         {TYPO_LIST}[{hash_number("concat('typo-pick|', row_key)")} % 5 + 1] AS typo
  FROM base
),
seeded AS (
  SELECT order_id,
         CASE WHEN seeded_null THEN NULL WHEN seeded_ghost THEN concat('ghost-', customer_id)
              ELSE customer_id END AS customer_id,
         product_id, quantity,
         total_amount * (CASE WHEN seeded_neg THEN -1 ELSE 1 END)
                      * (CASE WHEN seeded_math THEN 1.5 ELSE 1.0 END)::DOUBLE AS total_amount,
         CASE WHEN seeded_future THEN CAST({AS_OF} + 10000 AS DATE) ELSE order_date END AS order_date,
         CASE WHEN seeded_typo THEN upper(typo) ELSE status END AS status,
         batch_date, row_key, seeded_ghost, seeded_null, seeded_neg, seeded_math, seeded_future, seeded_typo
  FROM hits
),
seeded_copies AS (
  SELECT *, FALSE AS seeded_copy FROM seeded
  UNION ALL
  SELECT * EXCLUDE (rn), TRUE FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_date ORDER BY md5(concat('copy|', row_key))) AS rn
    FROM seeded)
  WHERE rn <= {hash_number("concat('copies|', CAST(batch_date AS VARCHAR))")} % 6
),
recall_rows AS ({flags("seeded_copies", ", o.seeded_ghost, o.seeded_null, o.seeded_neg, o.seeded_math, o.seeded_future, o.seeded_typo, o.seeded_copy", ", o.quantity, o.seeded_copy")}
)"""

PRELUDE = ",".join([_RAW, _STAGING, _MART, _TESTS, _SEEDED_SIX])


def with_prelude(body: str) -> str:
    return f"WITH {PRELUDE}\n{body}"
