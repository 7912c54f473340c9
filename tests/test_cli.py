"""The command line over a small source."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trustline.__main__ import main
from trustline.plans.report import report_tables
from trustline.sources import schemas
from trustline.sources.tables import read_snapshot


def test_backfill_daily_report(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    row = ("o1", "c1", "p1", "2", "20.0", "2024-01-01", "PENDING")
    orders = spark.createDataFrame([row], schemas.RAW_ORDERS)
    days = orders.withColumn("batch_date", F.explode(F.array(*[F.lit(dt.date(2024, 1, d)) for d in (1, 2)])))
    days.withColumn("order_id", F.concat("order_id", F.day("batch_date"))).write.parquet(at("source"))
    spark.createDataFrame([("c1", "n", "e", "2024-01-01", "EU")], schemas.RAW_CUSTOMERS).write.parquet(at("c"))
    spark.createDataFrame([("p1", "Home", "10.0", "3", "Cup")], schemas.RAW_PRODUCTS).write.parquet(at("p"))
    where = ["--landing", at("landing"), "--warehouse", at("house")]
    full = [*where, "--snapshot", at("snapshot")]
    source = ["--source", at("source")]

    main(["backfill", *full, *source, "--customers", at("c"), "--products", at("p"), "--as-of", "2024-01-01"])
    main(["daily", *full, *source, "--as-of", "2024-01-02"])
    assert read_snapshot(spark, at("snapshot")).agg(F.sum("order_count")).first()[0] == 2
    main(["load", *where, "--mode", "full"])
    main(["build", *full, "--as-of", "2024-01-02"])
    main(["report", "--warehouse", at("house"), "--snapshot", at("snapshot"), "--as-of", "2024-01-02"])
    assert "100.0%" in capsys.readouterr().out
    main(["reset", "--landing", at("landing")])
    assert not (tmp_path / "landing").exists()


def test_bad_arguments():
    with pytest.raises(SystemExit):
        main(["load", "--landing", "x", "--warehouse", "y", "--mode", "some"])
    with pytest.raises(SystemExit):
        main(["daily"])


def test_report_tables_of_an_empty_feed(spark):
    tables = report_tables(spark.createDataFrame([], schemas.FEED), "2024-01-01")
    assert tables["health_score"].first().health_score == 100.0
    assert tables["daily_revenue"].count() == 0 and tables["issue_drilldown"].count() == 0
