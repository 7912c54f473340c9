"""Command line: entry to the chains and their steps.

python -m trustline load     --landing L --warehouse W [--mode full|incremental]
python -m trustline build    --landing L --warehouse W --snapshot S [--as-of D]
python -m trustline daily    --landing L --warehouse W --snapshot S --source P [--as-of D] [--rate R]
python -m trustline backfill --landing L --warehouse W --snapshot S --source P
                             --customers P --products P [--as-of D] [--rate R]
python -m trustline report   --warehouse W --snapshot S [--as-of D]
python -m trustline reset    --landing L

``--source`` is a Parquet table of raw orders with a ``batch_date``.
"""

from __future__ import annotations

import argparse

from trustline import spark_session
from trustline.plans import pipeline
from trustline.plans.feed import load_feed
from trustline.plans.report import show_report
from trustline.sources.landing import reset_landing
from trustline.streaming.load import Warehouse, loaded_counts, run_load

# Command -> options it needs.
COMMANDS = {
    "load": ["landing", "warehouse"],
    "build": ["landing", "warehouse", "snapshot"],
    "daily": ["landing", "warehouse", "snapshot", "source"],
    "backfill": ["landing", "warehouse", "snapshot", "source", "customers", "products"],
    "report": ["warehouse", "snapshot"],
    "reset": ["landing"],
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trustline", description="Data quality of order data.")
    commands = top.add_subparsers(dest="command", required=True)
    for name, needed in COMMANDS.items():
        sub = commands.add_parser(name)
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        sub.add_argument("--as-of", default=None, help="date taken as today, yyyy-mm-dd")
        if name == "load":
            sub.add_argument("--mode", choices=["full", "incremental"], default="incremental")
        if name in ("daily", "backfill"):
            sub.add_argument("--rate", type=float, default=None, help="seed defects at this rate")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark_session()
    if args.command == "load":
        run_load(spark, args.landing, args.warehouse, args.mode)
        loaded_counts(spark, Warehouse(args.warehouse)).show()
    elif args.command == "report":
        show_report(load_feed(spark, Warehouse(args.warehouse).mart, args.snapshot), args.as_of)
    elif args.command == "reset":
        reset_landing(spark, args.landing)
    else:
        rate = getattr(args, "rate", None)
        config = pipeline.Config(args.landing, args.warehouse, args.snapshot, rate)
        if args.command == "build":
            results = pipeline.transform_and_report(spark, config, args.as_of)
        elif args.command == "daily":
            results = pipeline.run_daily(spark, config, spark.read.parquet(args.source), args.as_of)
        else:
            source, customers, products = (
                spark.read.parquet(p) for p in (args.source, args.customers, args.products)
            )
            results = pipeline.run_backfill(spark, config, source, customers, products, args.as_of)
        results.orderBy("test_name").show(truncate=False)


if __name__ == "__main__":
    main()
