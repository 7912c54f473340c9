"""Queries over what was landed, loaded and stored: the file-based operators end to end.

Each one writes test tables to a new folder of shared storage, goes through the operator
and returns what it reads back.  ``events`` supplies daily batches, one order per event.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustline.operators.calendar import high_water_mark
from trustline.operators.mart import clean_orders, dirty_orders
from trustline.operators.quality import PipelineGateError, Unique
from trustline.operators.rollup import daily_status_rollup
from trustline.plans import marks
from trustline.plans import oracle as o
from trustline.plans import pipeline as pl
from trustline.plans.catalog import FEED_SQL, Tables, query, rounded
from trustline.plans.feed import load_feed
from trustline.plans.mart_table import mart_versions, read_feed, read_mart
from trustline.sources import landing as lz
from trustline.sources import testdata as td
from trustline.sources.schemas import RAW_ORDERS
from trustline.sources.tables import (
    export_snapshot,
    hadoop_path,
    materialise,
    read_snapshot,
    require_dimensions,
    scratch_folder,
    write_daily,
    write_dimension,
)
from trustline.streaming import load as ld

SECOND_HALF = "2024-01-16"
BROKEN_EVERY = 10


def _landed(t: Tables, root: str, events: DataFrame | None = None) -> str:
    landing = f"{root}/landing"
    lz.land_batches(t.events if events is None else events, landing)
    return landing


def _with_dimensions(t: Tables, landing: str) -> str:
    lz.land_dimension(t.raw_customers, landing, "customers")
    lz.land_dimension(t.raw_products, landing, "products")
    return landing


def _first_half(t: Tables) -> DataFrame:
    return t.events.where(F.col("batch_date") < F.lit(SECOND_HALF).cast("date"))


def _second_half(t: Tables) -> DataFrame:
    return t.events.where(F.col("batch_date") >= F.lit(SECOND_HALF).cast("date"))


_EVENT_ORDERS = """
    SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
           CAST(NULL AS VARCHAR) AS product_id, '1' AS quantity,
           CAST(CAST(round(value, 2) AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS order_date, event_type AS status,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date
    FROM events"""


def _line() -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_ORDERS.names])


def _landed_broken(t: Tables, root: str) -> str:
    """The events as landing files in which each tenth line has two fields only."""
    landing = f"{root}/landing"
    broken = F.col("order_id").cast("bigint") % BROKEN_EVERY == 0
    line = F.when(broken, F.concat_ws(",", "order_id", "customer_id")).otherwise(_line())
    lines = t.events.select(line.alias(",".join(RAW_ORDERS.names)), "batch_date")
    write_daily(lines, f"{landing}/orders", "csv", cluster=True, header="true", sep="\u0001")
    return landing


@query("csv_landing_scan", _EVENT_ORDERS)
def _scan(t: Tables) -> DataFrame:
    landing = _landed(t, scratch_folder(t.spark, "scan"))
    scanned = lz.scan_batches(t.spark, landing)
    return lz.good_rows(scanned).select(*RAW_ORDERS.names, "batch_date")


@query(
    "malformed_quarantine",
    f"""
    SELECT *, CAST(NULL AS VARCHAR) AS malformed_record FROM ({_EVENT_ORDERS}) WHERE CAST(order_id AS BIGINT) % {BROKEN_EVERY} <> 0
    UNION ALL BY NAME
    SELECT concat(event_id, ',', user_id) AS malformed_record, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date
    FROM events WHERE event_id % {BROKEN_EVERY} = 0
    """,
)
def _malformed(t: Tables) -> DataFrame:
    """Good rows and the broken lines kept beside them."""
    scanned = lz.scan_batches(t.spark, _landed_broken(t, scratch_folder(t.spark, "malformed")))
    bad = lz.malformed_rows(scanned).drop("source_file")
    return lz.good_rows(scanned).unionByName(bad, allowMissingColumns=True)


@query(
    "load_report",
    f"""
    SELECT 'orders' AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date,
           count(*) FILTER (WHERE event_id % {BROKEN_EVERY} <> 0) AS row_count,
           count(*) FILTER (WHERE event_id % {BROKEN_EVERY} = 0) AS rejected,
           min(concat(event_id, ',', user_id)) FILTER (WHERE event_id % {BROKEN_EVERY} = 0) AS first_error
    FROM events GROUP BY CAST(ts AS DATE)
    UNION ALL SELECT 'customers', NULL, count(*), 0, NULL FROM raw_customers
    UNION ALL SELECT 'products', NULL, 0, count(*), min(product_id) FROM raw_products
    """,
)
def _load_report(t: Tables) -> DataFrame:
    """What a load took and rejected, its files summed up by day: their names differ by run."""
    root = scratch_folder(t.spark, "report")
    landing, house = _landed_broken(t, root), ld.Warehouse(f"{root}/warehouse")
    lz.land_dimension(t.raw_customers, landing, "customers")
    t.raw_products.select("product_id").write.option("header", True).csv(f"{landing}/products")
    ld.run_load(t.spark, landing, house)
    sums = [F.sum(c).alias(c) for c in ("row_count", "rejected")]
    return ld.load_report(t.spark, house).groupBy("entity", "batch_date").agg(*sums, F.min("first_error").alias("first_error"))


@query(
    "csv_hostile_roundtrip",
    """
    SELECT CAST(doc_id AS VARCHAR) AS order_id, source AS customer_id, lang AS product_id,
           CAST(n_chars AS VARCHAR) AS quantity, CAST(NULL AS VARCHAR) AS total_amount,
           CAST(NULL AS VARCHAR) AS order_date, CASE WHEN text NOT IN ('NULL', 'null', '') THEN text END AS status,
           CAST(CAST(DATE '2024-01-01' + CAST(doc_id % 3 AS INTEGER) AS DATE) AS VARCHAR) AS batch_date
    FROM documents
    """,
)
def _hostile(t: Tables) -> DataFrame:
    """Whole texts through the landing zone, line breaks and all."""
    landing = f"{scratch_folder(t.spark, 'hostile')}/landing"
    rows = t.spark.read.parquet(f"{t.sf_dir}/documents.parquet").selectExpr(
        "CAST(doc_id AS STRING) AS order_id", "source AS customer_id", "lang AS product_id",
        "CAST(n_chars AS STRING) AS quantity", "CAST(NULL AS STRING) AS total_amount",
        "CAST(NULL AS STRING) AS order_date", "text AS status",
        "date_add(DATE '2024-01-01', CAST(doc_id % 3 AS INT)) AS batch_date",
    )
    lz.land_batches(rows, landing)
    return lz.good_rows(lz.scan_batches(t.spark, landing))


def _lines_landed(t: Tables, root: str, status: Column, malformed: Column) -> str:
    """The events as landing files whose last field is written as it stands."""
    landing = f"{root}/landing"
    values = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RAW_ORDERS.names[:-1]], F.when(malformed, status).otherwise(F.col("status")))
    lines = t.events.select(values.alias(",".join(RAW_ORDERS.names)), "batch_date")
    write_daily(lines, f"{landing}/orders", "csv", cluster=True, header="true", sep="\u0001", quote="")
    return landing


@query(
    "csv_unclosed_quotes",
    f"""
    SELECT *, CAST(NULL AS VARCHAR) AS malformed_record FROM ({_EVENT_ORDERS}) WHERE CAST(order_id AS BIGINT) % {BROKEN_EVERY} <> 0
    UNION ALL BY NAME
    SELECT concat_ws(',', order_id, customer_id, '', quantity, total_amount, order_date, '"' || status) AS malformed_record, batch_date
    FROM ({_EVENT_ORDERS}) WHERE CAST(order_id AS BIGINT) % {BROKEN_EVERY} = 0
    """,
)
def _unclosed(t: Tables) -> DataFrame:
    """Each tenth line opens a quote that nothing closes: it is malformed as a whole, and only it."""
    tenth = F.col("order_id").cast("bigint") % BROKEN_EVERY == 0
    landing = _lines_landed(t, scratch_folder(t.spark, "unclosed"), F.concat(F.lit('"'), "status"), tenth)
    scanned = lz.scan_batches(t.spark, landing)
    return lz.good_rows(scanned).unionByName(lz.malformed_rows(scanned).drop("source_file"), allowMissingColumns=True)


@query(
    "line_breaks_daily",
    f"""
    SELECT * REPLACE (CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN status || chr(10) || '"then", so' ELSE status END AS status)
    FROM ({_EVENT_ORDERS})
    """,
)
def _line_breaks(t: Tables) -> DataFrame:
    """Both chains over orders of which each third has a line break in its status: all are in the raw table."""
    config = _chain(t, "line-breaks")
    broken = F.when(F.col("order_id").cast("bigint") % 3 == 0, F.concat("status", F.lit('\n"then", so'))).otherwise(F.col("status"))
    orders = t.events.withColumn("status", broken)
    pl.run_backfill(t.spark, config, orders, t.raw_customers, t.raw_products, "2024-01-15")
    pl.run_daily(t.spark, config, orders, td.EVENTS_AS_OF)
    return _loaded(t, config.warehouse)


# Bytes of a day's lines, without the header that each of its files has.
_BYTES = f"""
    SELECT batch_date, CAST(sum(strlen(concat_ws(',', order_id, customer_id, coalesce(product_id, ''), quantity,
                                                 total_amount, order_date, status)) + 1) AS BIGINT) AS line_bytes
    FROM ({_EVENT_ORDERS}) GROUP BY batch_date"""
_HEADER_BYTES = len(",".join(RAW_ORDERS.names)) + 1


def _line_bytes(files: DataFrame) -> DataFrame:
    return files.groupBy("batch_date").agg(F.sum(F.col("length") - _HEADER_BYTES).alias("line_bytes"))


@query("landing_file_inventory", _BYTES)
def _inventory(t: Tables) -> DataFrame:
    landing = _landed(t, scratch_folder(t.spark, "inventory"))
    return _line_bytes(lz.file_inventory(t.spark, landing))


@query("new_files", f"SELECT * FROM ({_BYTES}) WHERE batch_date >= '{SECOND_HALF}'")
def _new_files(t: Tables) -> DataFrame:
    root = scratch_folder(t.spark, "new-files")
    landing = _landed(t, root, _first_half(t))
    ledger = materialise(lz.file_inventory(t.spark, landing), f"{root}/ledger")
    _landed(t, root, _second_half(t))
    return _line_bytes(lz.new_files(lz.file_inventory(t.spark, landing), ledger))


def _loaded(t: Tables, house: ld.Warehouse) -> DataFrame:
    return ld.raw_orders(t.spark, house).drop("row_id")


@query("incremental_load", _EVENT_ORDERS)
def _incremental(t: Tables) -> DataFrame:
    """Half the days, the other half, and a day that is landed a second time."""
    root = scratch_folder(t.spark, "incremental")
    house = ld.Warehouse(f"{root}/warehouse")
    landing = _with_dimensions(t, _landed(t, root, _first_half(t)))
    ld.run_load(t.spark, landing, house)
    again = t.events.where(F.col("batch_date") == F.lit("2024-01-01").cast("date"))
    _landed(t, root, _second_half(t).unionByName(again))
    ld.run_load(t.spark, landing, house)
    ld.run_load(t.spark, landing, house)
    return _loaded(t, house)


@query("full_load", _EVENT_ORDERS)
def _full(t: Tables) -> DataFrame:
    """A full load over a warehouse that already holds everything."""
    root = scratch_folder(t.spark, "full")
    house = ld.Warehouse(f"{root}/warehouse")
    landing = _with_dimensions(t, _landed(t, root))
    ld.run_load(t.spark, landing, house)
    ld.run_load(t.spark, landing, house, "full")
    return _loaded(t, house)


@query("daily_partition_write", _EVENT_ORDERS)
def _daily_write(t: Tables) -> DataFrame:
    """The second write replaces the days it holds and leaves the others."""
    path = f"{scratch_folder(t.spark, 'daily')}/orders"
    write_daily(t.events, path, cluster=True)
    write_daily(_second_half(t), path, cluster=True)
    return t.spark.read.schema(t.events.schema).parquet(path)


@query(
    "dimension_overwrite",
    "SELECT customer_id, name, email, signup_date, region FROM raw_customers",
)
def _dimension(t: Tables) -> DataFrame:
    path = f"{scratch_folder(t.spark, 'dimension')}/customers"
    write_dimension(t.raw_customers.limit(1), path)
    write_dimension(t.raw_customers, path)
    return require_dimensions(t.spark, {"customers": path})["customers"]


@query(
    "materialise_mart",
    "SELECT * EXCLUDE (dirty) REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM marked",
)
def _mart(t: Tables) -> DataFrame:
    """The clean and the dirty half of the stored mart."""
    mart = materialise(t.fct, f"{scratch_folder(t.spark, 'mart')}/fct_orders")
    return clean_orders(mart).unionByName(dirty_orders(mart))


@query("snapshot_roundtrip", FEED_SQL.format("feed"))
def _snapshot(t: Tables) -> DataFrame:
    path = f"{scratch_folder(t.spark, 'snapshot')}/feed"
    export_snapshot(t.feed, path)
    return rounded(read_snapshot(t.spark, path))


@query("feed_fallback", FEED_SQL.format("feed"))
def _fallback(t: Tables) -> DataFrame:
    root = scratch_folder(t.spark, "fallback")
    export_snapshot(t.feed, f"{root}/feed")
    return rounded(load_feed(t.spark, f"{root}/no_mart", f"{root}/feed"))


@query("feed_fallback_unreadable", FEED_SQL.format("feed"))
def _unreadable(t: Tables) -> DataFrame:
    """A mart with a file that is no Parquet: the rollup fails while it runs."""
    root = scratch_folder(t.spark, "unreadable")
    stored = materialise(t.fct, f"{root}/mart")
    export_snapshot(daily_status_rollup(stored), f"{root}/feed")
    stored.select("order_id").write.mode("append").text(f"{root}/mart")
    return rounded(load_feed(t.spark, f"{root}/mart", f"{root}/feed"))


@query("commit_high_water", "SELECT CAST(max(batch_date) AS VARCHAR) AS high_water FROM event_orders")
def _commit(t: Tables) -> DataFrame:
    house = ld.Warehouse(scratch_folder(t.spark, "marks"))
    mark = high_water_mark(t.events, as_of=td.EVENTS_AS_OF).first().high_water
    pl.commit_high_water(t.spark, house, SECOND_HALF)
    pl.commit_high_water(t.spark, house, mark)
    return pl.read_high_water(t.spark, house, td.EVENTS_AS_OF)


# Raw orders over 28 daily batches; the rows of one order are on different days.
LAST_OF_FIRST = "2001-01-14"


def dated(t: Tables) -> DataFrame:
    """The raw orders with the daily batch each belongs to."""
    day = F.date_add(F.lit("2001-01-01").cast("date"), F.col("quantity").cast("int") % 28)
    return t.raw_orders.select(*RAW_ORDERS.names, day.alias("batch_date"))


def _stored(t: Tables, name: str) -> DataFrame:
    """The dated orders as a table of their own, for chains that land rows more than once: they are made once."""
    return materialise(dated(t), f"{scratch_folder(t.spark, name)}/source")


def _until(orders: DataFrame, day: str = LAST_OF_FIRST) -> DataFrame:
    return orders.where(F.col("batch_date") <= F.lit(day).cast("date"))


def _chain(t: Tables, name: str, rate: float | None = None) -> pl.Config:
    root = scratch_folder(t.spark, name)
    return pl.Config(f"{root}/landing", f"{root}/warehouse", f"{root}/feed", rate)


@query("backfill_then_daily", FEED_SQL.format("feed"))
def _chains(t: Tables) -> DataFrame:
    """Both chains in turn, without seeding; returns the snapshot they leave."""
    config, orders = _chain(t, "chains"), dated(t)
    pl.run_backfill(t.spark, config, orders, t.raw_customers, t.raw_products, LAST_OF_FIRST)
    pl.run_daily(t.spark, config, orders, td.AS_OF)
    return rounded(read_snapshot(t.spark, config.snapshot))


_FEED_OF = f"""
    SELECT CAST(order_date AS VARCHAR) AS order_date, status, count(*) AS order_count,
           round(sum(total_amount), 2) AS total_revenue,
           round(sum(CASE WHEN is_orphan_order OR has_negative_amount OR is_duplicate OR is_future_order
                            OR has_math_error OR has_bad_status THEN 0 ELSE total_amount END), 2) AS clean_revenue,
           count(*) FILTER (WHERE is_orphan_order) AS orphan_orders,
           count(*) FILTER (WHERE has_negative_amount) AS negative_amount_orders,
           count(*) FILTER (WHERE is_duplicate) AS duplicate_orders,
           count(*) FILTER (WHERE is_future_order) AS future_orders,
           count(*) FILTER (WHERE has_math_error) AS math_errors,
           count(*) FILTER (WHERE has_bad_status) AS bad_status_orders
    FROM ({o.flags("part_orders")}) GROUP BY order_date, status"""


@query(
    "pipeline_gate",
    _FEED_OF.replace(
        "part_orders o",
        f"""(SELECT s.* FROM stg_orders s
             WHERE CAST(DATE '2001-01-01' + s.quantity % 28 AS DATE) <= DATE '{LAST_OF_FIRST}') o""",
    ),
)
def _gate(t: Tables) -> DataFrame:
    """New rows, then a test of severity ``error`` that fails: the old snapshot stays."""
    config, orders = _chain(t, "gate"), _stored(t, "gate")
    pl.run_backfill(t.spark, config, _until(orders), t.raw_customers, t.raw_products, td.AS_OF)
    lz.land_batches(orders, config.landing)
    ld.run_load(t.spark, config.landing, config.warehouse)
    try:
        pl.transform_and_report(t.spark, config, td.AS_OF, specs=[Unique("fct_orders", "status")])
    except PipelineGateError:
        return rounded(read_snapshot(t.spark, config.snapshot))
    raise AssertionError("the gate let a failing test pass")


@query("incremental_mart", "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM fct")
def _incremental_mart(t: Tables) -> DataFrame:
    """A mart of half the days, an earlier date and other dimensions, then brought up to all of it."""
    root = scratch_folder(t.spark, "incremental-mart")
    house, landing, orders = ld.Warehouse(f"{root}/warehouse"), f"{root}/landing", dated(t)
    odd = F.col("customer_id").cast("bigint") % 40
    customers = t.raw_customers.where(odd != 0).withColumn("region", F.when(odd > 1, F.col("region")))
    lz.land_batches(_until(orders), landing)
    lz.land_dimension(customers, landing, "customers")
    lz.land_dimension(t.raw_products, landing, "products")
    ld.run_load(t.spark, landing, house)
    pl.build_models(t.spark, house, LAST_OF_FIRST)
    lz.land_batches(orders.where(F.col("batch_date") > F.lit(LAST_OF_FIRST).cast("date")), landing)
    lz.land_dimension(t.raw_customers, landing, "customers")
    ld.run_load(t.spark, landing, house)
    return pl.build_models(t.spark, house, td.AS_OF)["fct_orders"]


@query(
    "pinned_mart",
    "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM ("
    + o.flags(
        f"""(SELECT s.* FROM stg_orders s
             WHERE CAST(DATE '2001-01-01' + s.quantity % 28 AS DATE) <= DATE '{LAST_OF_FIRST}')"""
    )
    + ")",
)
def _pinned_mart(t: Tables) -> DataFrame:
    """The mart as a reader has it who opened it before a build that changed every day of it."""
    config, orders = _chain(t, "pinned"), _stored(t, "pinned")
    pl.run_backfill(t.spark, config, _until(orders), t.raw_customers, t.raw_products, td.AS_OF)
    pinned = read_mart(t.spark, config.warehouse, mart_versions(config.warehouse).numbers(t.spark)[-1])
    lz.land_batches(orders.withColumn("status", F.lit("SHIPPED")), config.landing)
    ld.run_load(t.spark, config.landing, config.warehouse)
    pl.build_models(t.spark, config.warehouse, td.AS_OF)
    return pinned.drop("batch_date")


@query("merged_day_cells", FEED_SQL.format("feed"))
def _merged(t: Tables) -> DataFrame:
    """The feed of a mart that was built in two steps, merged from the cells of its days."""
    config, orders = _chain(t, "merged"), dated(t)
    pl.run_backfill(t.spark, config, _until(orders), t.raw_customers, t.raw_products, LAST_OF_FIRST)
    lz.land_batches(orders.where(F.col("batch_date") > F.lit(LAST_OF_FIRST).cast("date")), config.landing)
    ld.run_load(t.spark, config.landing, config.warehouse)
    pl.build_models(t.spark, config.warehouse, td.AS_OF)
    return rounded(read_feed(t.spark, config.warehouse))


_ODD_DAY = "extract('day' FROM CAST(batch_date AS DATE)) % 2 = 1"


@query(
    "schema_drift",
    f"""
    SELECT DISTINCT batch_date,
           CASE WHEN {_ODD_DAY} THEN 'customer_id,order_id,product_id,quantity,total_amount,order_date,status'
                ELSE 'order_id,customer_id,product_id,quantity,total_amount,order_date,status' END AS header,
           '' AS missing, '' AS extra, CASE WHEN {_ODD_DAY} THEN 'moved' ELSE 'ok' END AS status
    FROM ({_EVENT_ORDERS})
    """,
)
def _drift(t: Tables) -> DataFrame:
    """Days with an odd number were landed with two columns exchanged; the files of a day say the same."""
    landing = f"{scratch_folder(t.spark, 'drift')}/landing"
    odd = F.dayofmonth("batch_date") % 2 == 1
    names = RAW_ORDERS.names
    write_daily(t.events.where(~odd).select(*names, "batch_date"), f"{landing}/orders", "csv", cluster=True, header="true")
    moved = t.events.where(odd).select(names[1], names[0], *names[2:], "batch_date")
    write_daily(moved, f"{landing}/orders", "csv", cluster=True, header="true")
    return lz.headers(t.spark, landing, "orders").drop("source_file").distinct()


@query("removed_files", f"SELECT * FROM ({_EVENT_ORDERS}) WHERE batch_date >= '{SECOND_HALF}' OR CAST(order_id AS BIGINT) % 2 = 0")
def _removed(t: Tables) -> DataFrame:
    """Each day is landed as two files; of the first half's days one goes after the load."""
    root = scratch_folder(t.spark, "removed")
    house, landing = ld.Warehouse(f"{root}/warehouse"), f"{root}/landing"
    names = [*RAW_ORDERS.names, "batch_date"]
    for rest in (0, 1):
        half = t.events.where(F.col("order_id").cast("bigint") % 2 == rest).select(*names)
        write_daily(half, f"{landing}/orders/part={rest}", "csv", cluster=True, header="true")
    ld.run_load(t.spark, landing, house)
    for day in sorted({r.batch_date for r in _first_half(t).select("batch_date").distinct().collect()}):
        fs, path = hadoop_path(t.spark, f"{landing}/orders/part=1/batch_date={day}")
        fs.delete(path, True)
    ld.run_load(t.spark, landing, house)
    return _loaded(t, house)


@query(
    "landing_log",
    f"""
    SELECT state, CAST("end" AS VARCHAR) AS "end", rows, outside, undated FROM (
      SELECT 'landed' AS state, DATE '2024-01-15' AS "end", count(*) FILTER (WHERE batch_date < '{SECOND_HALF}') AS rows,
             count(*) FILTER (WHERE batch_date >= '{SECOND_HALF}') AS outside, 0 AS undated FROM event_orders
      UNION ALL
      SELECT 'landed', DATE '{td.EVENTS_AS_OF}', count(*) FILTER (WHERE batch_date >= '{SECOND_HALF}'),
             count(*) FILTER (WHERE batch_date < '{SECOND_HALF}'), 0 FROM event_orders
      UNION ALL SELECT 'landing', DATE '2024-01-15', NULL, NULL, NULL
      UNION ALL SELECT 'landing', DATE '{td.EVENTS_AS_OF}', NULL, NULL, NULL
      UNION ALL SELECT 'landing', DATE '{td.EVENTS_AS_OF}', NULL, NULL, NULL
      UNION ALL SELECT 'failed', DATE '{td.EVENTS_AS_OF}', NULL, NULL, NULL)
    """,
)
def _landing_log(t: Tables) -> DataFrame:
    """The log of a backfill and a daily run, which had to wait for another run that claimed its window and failed."""
    config = _chain(t, "log")
    pl.run_backfill(t.spark, config, t.events, t.raw_customers, t.raw_products, "2024-01-15")
    start, end = dt.date.fromisoformat(SECOND_HALF), dt.date.fromisoformat(td.EVENTS_AS_OF)
    try:
        with marks.landing(t.spark, config.warehouse, start, end):
            try:
                pl.ingest(t.spark, config, t.events, td.EVENTS_AS_OF)
            except marks.ConcurrentRunError:
                raise InterruptedError from None
    except InterruptedError:
        pl.ingest(t.spark, config, t.events, td.EVENTS_AS_OF)
    pl.ingest(t.spark, config, t.events, td.EVENTS_AS_OF)  # has nothing to do
    return marks.steps(t.spark, config.warehouse).select("state", "end", "rows", "outside", "undated")


@query("quarantine_replay", _EVENT_ORDERS)
def _replay(t: Tables) -> DataFrame:
    """Broken lines are quarantined, corrected and replayed twice, and their days then rebuilt from the landing files."""
    root = scratch_folder(t.spark, "replay")
    landing, house = _landed_broken(t, root), ld.Warehouse(f"{root}/warehouse")
    ld.run_load(t.spark, landing, house)
    whole = t.events.select(F.col("order_id").alias("id"), _line().alias("corrected"))
    bad = ld.quarantined_lines(t.spark, house).withColumn("id", F.substring_index(lz.MALFORMED, ",", 1))
    fixes = materialise(bad.join(whole, "id").select("source_file", lz.MALFORMED, "corrected"), f"{root}/fixes")
    for _ in range(2):
        days = ld.replay(t.spark, landing, house, fixes)
    ld.rebuild_days(t.spark, landing, house, days)
    return _loaded(t, house)
