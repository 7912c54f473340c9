"""The two chains: daily (incremental) and backfill (full)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trustline.operators import calendar, monitors, quality
from trustline.operators.defects import seed_all
from trustline.operators.mart import as_of_date
from trustline.operators.staging import stg_customers, stg_orders, stg_products
from trustline.plans import marks
from trustline.plans.mart_table import build_mart, read_feed, read_mart
from trustline.sources import landing as lz
from trustline.sources.schemas import DQ_RESULTS, FCT_ORDERS, RAW_ORDERS
from trustline.sources.tables import (
    create_views,
    exists,
    export_snapshot,
    materialise,
    read_table,
    require_dimensions,
    shuffles_freed,
)
from trustline.streaming.load import Warehouse, raw_dimension, raw_order_ids, raw_orders, run_load


@dataclass(frozen=True)
class Config:
    """Where a pipeline reads and writes.

    ``rate`` seeds defects into the landed batches, for tests of the detectors; by default
    they are landed as they are.  ``seed_keys`` are columns that tell the source's rows apart.
    A backfill lands all of the source, or its last ``history_days`` days where that is given.
    """

    landing: str
    warehouse_root: str
    snapshot: str
    rate: float | None = None
    seed_keys: list[str] = field(default_factory=lambda: ["order_id", "product_id"])
    history_days: int | None = None

    @property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.warehouse_root)


def read_high_water(
    spark: SparkSession, warehouse: Warehouse, as_of: dt.date | str | None = None
) -> DataFrame:
    return calendar.high_water_mark(marks.landed_days(spark, warehouse), as_of=as_of)


def commit_high_water(spark: SparkSession, warehouse: Warehouse, day: dt.date | str | None) -> None:
    """Record that all batches up to ``day`` have landed; the latest such day counts."""
    marks.commit(spark, warehouse, spark.range(1).select(as_of_date(day).alias("d")).first().d)


class Landed(NamedTuple):
    """Rows of the source that were landed, that lie outside the window, and that have no batch date."""

    rows: int
    outside: int
    undated: int


def _seeded(batch: DataFrame, config: Config, as_of: dt.date | str | None) -> DataFrame:
    """Seed the text columns; a row that isn't hit keeps its texts to the byte."""
    kept = {"total_amount": "_total_amount", "order_date": "_order_date"}
    typed = batch.withColumns({copy: F.col(c).cast("string") for c, copy in kept.items()}).withColumns(
        {"total_amount": F.col("total_amount").try_cast("double"), "order_date": F.col("order_date").try_cast("date")}
    )
    seeded = seed_all(typed, config.seed_keys, "batch_date", config.rate, as_of, markers=True)
    hit = {"total_amount": F.col("seeded_neg") | F.col("seeded_math"), "order_date": F.col("seeded_future")}
    texts = {c: F.coalesce(F.when(hit[c], F.col(c).cast("string")), F.col(copy)) for c, copy in kept.items()}
    return seeded.withColumns(texts)


def land_window(
    spark: SparkSession,
    config: Config,
    source: DataFrame,
    start: dt.date | None,
    end: dt.date,
    as_of: dt.date | str | None,
) -> Landed:
    """Land the source's batches from ``start`` (None: the first) to ``end``, all days in one job.

    The rows are counted as they are written; what is left out is counted by its dates alone.
    """
    day = F.col("batch_date")
    inside = day <= F.lit(end) if start is None else day.between(start, end)
    with shuffles_freed(spark):
        left = source.agg(F.count_if(~inside).alias("outside"), F.count_if(day.isNull()).alias("undated")).first()
    batch = source.where(inside)
    if config.rate is not None:
        batch = _seeded(batch, config, as_of)
    text = [F.col(c).cast("string").alias(c) for c in RAW_ORDERS.names]
    written = Observation("landed")
    lz.land_batches(batch.select(*text, "batch_date").observe(written, F.count("*").alias("rows")), config.landing)
    return Landed(written.get["rows"], left.outside, left.undated)


def ingest(
    spark: SparkSession, config: Config, source: DataFrame, as_of: dt.date | str | None = None
) -> int:
    """Land the days after the high-water date; returns how many days there were.

    The window is claimed first, so that of two runs at once one lands it (:mod:`marks`); what was
    landed and left out is in :func:`marks.steps`.
    """
    mark = read_high_water(spark, config.warehouse, as_of)
    window = calendar.incremental_window(mark, as_of).first()
    if window.day_count:
        with marks.landing(spark, config.warehouse, window.start_date, window.end_date) as counts:
            counts |= land_window(spark, config, source, window.start_date, window.end_date, as_of)._asdict()
    return window.day_count


def build_models(
    spark: SparkSession, warehouse: Warehouse, as_of: dt.date | str | None = None, full: bool = False
) -> dict[str, DataFrame]:
    """Stage the raw tables as views and bring the stored mart and its feed up to them."""
    require_dimensions(spark, {e: warehouse.dimension(e) for e in ("customers", "products")})
    orders = stg_orders(raw_orders(spark, warehouse))
    customers = stg_customers(raw_dimension(spark, warehouse, "customers"))
    products = stg_products(raw_dimension(spark, warehouse, "products"))
    build_mart(spark, warehouse, orders, customers, products, as_of, full, raw_order_ids(spark, warehouse))
    models = {
        "stg_orders": orders,
        "stg_customers": customers,
        "stg_products": products,
        "fct_orders": read_mart(spark, warehouse).select(*FCT_ORDERS.names),
    }
    create_views(models)
    return models


def store_monitors(
    warehouse: Warehouse, models: dict[str, DataFrame], as_of: dt.date | str | None = None
) -> dict[str, DataFrame]:
    """Store the mart's dirty rows with their reasons, and what freshness, volume and schema monitors say."""
    mart = models["fct_orders"]
    found = {
        "quarantine": quality.quarantine_rows(mart),
        "freshness": monitors.freshness({"fct_orders": (mart, "order_date")}, as_of),
        "volume": monitors.volume_anomaly(mart, as_of=as_of),
        "schema": monitors.schema_check(mart, FCT_ORDERS),
    }
    return {name: materialise(df, warehouse.monitor(name)) for name, df in found.items()}


def monitor_tables(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """The stored monitors by name, as far as there are any."""
    paths = {name: warehouse.monitor(name) for name in ("quarantine", "freshness", "volume", "schema")}
    return {name: spark.read.parquet(path) for name, path in paths.items() if exists(spark, path)}


def transform_and_report(
    spark: SparkSession,
    config: Config,
    as_of: dt.date | str | None = None,
    run_at: dt.datetime | None = None,
    specs: list[quality.ColumnTest] | None = None,
    full: bool = False,
) -> DataFrame:
    """Bring the mart up to date, store what the monitors find, test, log the results and, if no test failed, refresh the snapshot."""
    models = build_models(spark, config.warehouse, as_of, full)
    store_monitors(config.warehouse, models, as_of)
    results = quality.log_results(quality.run_tests(models, specs, run_at), config.warehouse.results)
    quality.require_no_failures(results)
    export_snapshot(read_feed(spark, config.warehouse), config.snapshot)
    return results


def results_log(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return read_table(spark, warehouse.results, DQ_RESULTS)


def run_daily(
    spark: SparkSession,
    config: Config,
    source: DataFrame,
    as_of: dt.date | str | None = None,
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """Ingest, load what is new, rebuild and test, refresh the snapshot; stops at the first error."""
    ingest(spark, config, source, as_of)
    run_load(spark, config.landing, config.warehouse, "incremental")
    return transform_and_report(spark, config, as_of, run_at)


def run_backfill(
    spark: SparkSession,
    config: Config,
    source: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: dt.date | str | None = None,
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """Empty the landing zone, land dimensions and history, load in full, rebuild and test."""
    end = spark.range(1).select(as_of_date(as_of).alias("d")).first().d
    start = None if config.history_days is None else end - dt.timedelta(days=config.history_days)
    with marks.landing(spark, config.warehouse, start, end) as counts:
        lz.reset_landing(spark, config.landing)
        lz.land_dimension(customers, config.landing, "customers")
        lz.land_dimension(products, config.landing, "products")
        counts |= land_window(spark, config, source, start, end, as_of)._asdict()
    run_load(spark, config.landing, config.warehouse, "full")
    return transform_and_report(spark, config, as_of, run_at, full=True)
