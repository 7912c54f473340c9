"""Headline timings, printed as one JSON line.

BENCH_SF_DIR   test tables (default /root/testdata/sf0.1)
BENCH_CPUS     threads of local[N] (default 8)

The raw tables are derived from the test tables and stored once (``load_raw``), the
mart is built from them and stored (``build_mart``), and the other queries run on what
the pipeline would read at that point.  Each is run three times; the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trustline import spark_session  # noqa: E402
from trustline.operators.rollup import daily_status_rollup  # noqa: E402
from trustline.plans import catalog_storage as storage  # noqa: E402
from trustline.plans.catalog import BUILDERS, Tables  # noqa: E402
from trustline.plans.pipeline import build_models  # noqa: E402
from trustline.sources.landing import land_batches, land_dimension  # noqa: E402
from trustline.sources.tables import materialise, scratch_folder  # noqa: E402
from trustline.sources.testdata import AS_OF  # noqa: E402
from trustline.streaming import load as ld  # noqa: E402

# From the stored raw tables, the whole plan each time.
FROM_RAW = [
    "daily_status_rollup",
    "fct_orders",
    "order_row_number",
    "stg_orders",
    "test_unique_order_id",
    "seed_negative",
    "seed_duplicates",
    "seed_exact_per_batch",
    "detector_recall",
]
# From the stored mart.
FROM_MART = [
    "defect_counts",
    "clean_revenue_by_date",
    "quarantine_by_reason",
    "dq_results",
    "health_score",
    "daily_revenue_long",
    "revenue_at_risk",
    "orders_by_status_bucket",
    "issue_breakdown",
]
# Straight from the test tables.
FROM_TEST_TABLES = ["rows_per_batch", "missing_days"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action, repeat: int = 3) -> float:
    elapsed = []
    for _ in range(repeat):
        start = time.perf_counter()
        action()
        elapsed.append(time.perf_counter() - start)
    return round(min(elapsed), 3)


# With a threshold so low that every key is hot and takes the salted way.
HOT = ["hot_row_number", "hot_flag_duplicate", "hot_fct_orders"]


def chain(spark, t: Tables, root: str) -> dict[str, float]:
    """Seconds of landing, loading and building 28 days, and of one more day on top."""
    house, landing = ld.Warehouse(f"{root}/warehouse"), f"{root}/landing"
    orders = storage.dated(t)
    last = orders.where("batch_date = DATE '2001-01-28'")
    land_dimension(t.raw_customers, landing, "customers")
    land_dimension(t.raw_products, landing, "products")
    return {
        "csv_land": timed(lambda: land_batches(orders, landing), 1),
        "csv_load": timed(lambda: ld.run_load(spark, landing, house), 1),
        "mart_full": timed(lambda: build_models(spark, house, AS_OF, full=True), 1),
        "csv_land_one_day": timed(lambda: land_batches(last, landing), 1),
        "csv_load_one_day": timed(lambda: ld.run_load(spark, landing, house), 1),
        "mart_one_day": timed(lambda: build_models(spark, house, AS_OF), 1),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "trustline-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_folder(spark, "bench")
    times: dict[str, float] = {}

    source = Tables(spark, sf_dir)
    times["load_raw"] = timed(lambda: source.stored(root, int(cpus)))
    stored = source.stored(root, int(cpus))

    def fresh() -> Tables:
        t = Tables(spark, sf_dir)
        for name in ("raw_orders", "dealt_orders", "base_orders", "raw_customers", "raw_products", "order_ids"):
            setattr(t, name, getattr(stored, name))
        return t

    for name in FROM_RAW:
        times[name] = timed(lambda name=name: run(BUILDERS[name](fresh())))
    times["build_mart"] = timed(lambda: materialise(fresh().fct, f"{root}/fct_orders"))

    def on_mart() -> Tables:
        t = fresh()
        t.fct = spark.read.parquet(f"{root}/fct_orders")
        return t

    times["rollup_of_mart"] = timed(lambda: run(daily_status_rollup(on_mart().fct)))
    for name in FROM_MART:
        times[name] = timed(lambda name=name: run(BUILDERS[name](on_mart())))
    for name in FROM_TEST_TABLES:
        times[name] = timed(lambda name=name: run(BUILDERS[name](Tables(spark, sf_dir))))
    for name in HOT:
        times[name] = timed(lambda name=name: run(BUILDERS[name](fresh())))
    times |= chain(spark, fresh(), f"{root}/chain")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(v for name, v in times.items() if name != "load_raw"), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
