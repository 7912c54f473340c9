"""Both chains end to end."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from trustline.operators import quality
from trustline.operators.defects import DETECTED_BY
from trustline.plans import mart_table
from trustline.plans import pipeline as pl
from trustline.plans.feed import live_feed, load_feed
from trustline.operators.rollup import daily_status_rollup
from trustline.plans.mart_table import mart_versions, read_feed, read_mart
from trustline.sources import landing as lz
from trustline.sources import schemas
from trustline.sources.tables import MissingDimensionError, read_snapshot, write_daily
from trustline.sources.versions import Versions
from trustline.streaming.load import raw_orders, run_load

START = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(f"c{i}", f"n{i}", f"e{i}", "2024-01-01", "EU") for i in range(5)]
    return spark.createDataFrame(rows, schemas.RAW_CUSTOMERS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("p1", "Home", "10.0", "3", "Cup")], schemas.RAW_PRODUCTS)


@pytest.fixture(scope="module")
def source(spark):
    """Twelve days of sixty clean orders each."""
    n = spark.range(720).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("customer_id"),
        F.lit("p1").alias("product_id"),
        F.lit("2").alias("quantity"),
        F.lit("20.0").alias("total_amount"),
        F.date_add(F.lit(START), (F.col("id") / 60).cast("int")).alias("batch_date"),
    )
    return n.select("*", F.col("batch_date").cast("string").alias("order_date"), F.lit("PENDING").alias("status"))


def config(tmp_path, rate):
    return pl.Config(str(tmp_path / "landing"), str(tmp_path / "house"), str(tmp_path / "snapshot"), rate)


def day(n):
    return START + dt.timedelta(days=n)


def test_clean_backfill_then_daily(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, None)
    results = pl.run_backfill(spark, cfg, source, customers, products, day(4))
    assert {r.status for r in results.collect()} == {"pass"} and results.count() == 10
    assert raw_orders(spark, cfg.warehouse).count() == 300
    assert pl.read_high_water(spark, cfg.warehouse, day(4)).first().high_water == day(4)

    for _ in range(2):  # the second run has nothing to do
        pl.run_daily(spark, cfg, source, day(6))
        assert raw_orders(spark, cfg.warehouse).count() == 420
    assert read_snapshot(spark, cfg.snapshot).agg(F.sum("order_count")).first()[0] == 420
    assert load_feed(spark, cfg.warehouse.mart, cfg.snapshot).agg(F.sum("clean_revenue")).first()[0] == 8400.0
    assert pl.results_log(spark, cfg.warehouse).count() == 30


def test_seeded_backfill_shows_every_defect(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, 0.4)
    results = {r.test_name: r for r in pl.run_backfill(spark, cfg, source, customers, products, day(11)).collect()}
    assert results["between_fct_orders_total_amount"].status == "warn"
    assert results["relationships_fct_orders_customer_id"].status == "warn"
    assert results["unique_stg_orders_order_id"].status == "warn"
    mart = read_mart(spark, cfg.warehouse)
    assert spark.sql("select count(*) from fct_orders").first()[0] == mart.count()
    assert spark.sql("select count(*) from stg_orders").first()[0] == mart.count()
    found = mart.agg(*[F.count_if(f).alias(f) for f in set(DETECTED_BY.values())]).first().asDict()
    assert all(n > 0 for n in found.values()), found


def test_failing_test_closes_the_gate(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, None)
    broken = source.withColumn("order_id", F.when(F.col("order_id") != "o7", F.col("order_id")))
    with pytest.raises(quality.PipelineGateError, match="not_null_stg_orders_order_id"):
        pl.run_backfill(spark, cfg, broken, customers, products, day(2))
    assert read_snapshot(spark, cfg.snapshot).count() == 0
    failed = quality.failed_results(pl.results_log(spark, cfg.warehouse))
    assert {r.test_name for r in failed.where("status = 'fail'").collect()} == {
        "not_null_stg_orders_order_id", "not_null_fct_orders_order_id",
    }


def test_build_stores_monitors_and_quarantine(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, 0.5)
    pl.run_backfill(spark, cfg, source, customers, products, day(11))
    stored = pl.monitor_tables(spark, cfg.warehouse)
    assert set(stored) == {"quarantine", "freshness", "volume", "schema"}
    mart = read_mart(spark, cfg.warehouse)
    dirty = mart.where(" or ".join(c for c in mart.columns if c.startswith(("is_", "has_")))).count()
    assert stored["quarantine"].count() == dirty > 0
    assert stored["quarantine"].where("size(reasons) = 0").isEmpty()
    assert [r.table_name for r in stored["freshness"].collect()] == ["fct_orders"]
    assert stored["schema"].where("status != 'ok'").isEmpty() and stored["volume"].count() >= 1


def test_landing_reports_what_it_leaves_out(spark, source, tmp_path):
    undated = source.limit(7).withColumn("batch_date", F.lit(None).cast("date"))
    landed = pl.land_window(spark, config(tmp_path, None), source.unionByName(undated), day(2), day(3), day(3))
    assert landed == (120, source.count() - 120, 7)


def test_seeding_keeps_the_texts_of_rows_it_does_not_hit(spark, source, tmp_path):
    odd = source.withColumn("total_amount", F.lit(" abc")).withColumn("order_date", F.lit("not-a-date"))
    cfg = config(tmp_path, 0.2)
    pl.land_window(spark, cfg, odd, None, day(11), day(11))
    rows = lz.good_rows(lz.scan_batches(spark, cfg.landing))
    assert rows.where("total_amount != ' abc'").isEmpty()
    assert {r.order_date for r in rows.select("order_date").distinct().collect()} >= {"not-a-date"}


def test_models_need_dimensions(spark, tmp_path):
    with pytest.raises(MissingDimensionError):
        pl.build_models(spark, config(tmp_path, None).warehouse)


def test_backfill_history_is_bounded(spark, customers, products, source, tmp_path):
    cfg = pl.Config(str(tmp_path / "l"), str(tmp_path / "w"), str(tmp_path / "s"), None, history_days=2)
    pl.run_backfill(spark, cfg, source, customers, products, day(11))
    assert raw_orders(spark, cfg.warehouse).count() == 180


def test_landed_rows_are_counted(spark, source, tmp_path):
    cfg = config(tmp_path, None)
    assert pl.land_window(spark, cfg, source, day(2), day(3), day(3)).rows == 120


def test_ingest_window_and_mark(spark, source, tmp_path):
    cfg = config(tmp_path, None)
    assert pl.ingest(spark, cfg, source, day(3)) == 1  # no mark: yesterday
    assert pl.ingest(spark, cfg, source, day(3)) == 0
    assert pl.ingest(spark, cfg, source, day(5)) == 2
    pl.commit_high_water(spark, cfg.warehouse, day(1))  # an older mark never wins
    assert pl.read_high_water(spark, cfg.warehouse).first().high_water == day(5)


def files(spark, cfg):
    """Files of the stored mart by day."""
    found = {}
    for path in read_mart(spark, cfg.warehouse).inputFiles():
        found.setdefault(lz_day(path), set()).add(path)
    return found


def lz_day(path):
    return dt.date.fromisoformat(path.split("batch_date=")[1][:10])


def rows_of(df):
    return sorted(df.collect(), key=repr)


def rebuilt(spark, cfg, as_of, compare=True):
    """The days of the mart that a build touches; its rows must equal those of a full rebuild."""
    before = files(spark, cfg)
    pl.build_models(spark, cfg.warehouse, as_of)
    after, rows = files(spark, cfg), rows_of(read_mart(spark, cfg.warehouse))
    touched = {d for d in before.keys() | after.keys() if before.get(d) != after.get(d)}
    if not compare:
        return touched
    feed = rows_of(live_feed(spark, cfg.warehouse.mart))
    pl.build_models(spark, cfg.warehouse, as_of, full=True)
    assert rows == rows_of(read_mart(spark, cfg.warehouse))
    assert feed == rows_of(live_feed(spark, cfg.warehouse.mart))
    return touched


def test_only_touched_days_of_the_mart_are_rebuilt(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, None)
    ahead = F.when(F.col("order_id") == "o70", F.lit(str(day(20)))).otherwise(F.col("order_date"))
    source = source.withColumn("order_date", ahead)
    pl.run_backfill(spark, cfg, source, customers, products, day(5))
    assert rebuilt(spark, cfg, day(5), compare=False) == set()
    # A new day with a copy of an order of day 2.
    copy = source.where("order_id = 'o130'").withColumn("batch_date", F.lit(day(6)))
    lz.land_batches(source.where(F.col("batch_date") == day(6)).unionByName(copy), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(6)) == {day(2), day(6)}
    assert read_mart(spark, cfg.warehouse).where("is_duplicate").count() == 1
    # The copy goes again, and the day keeps its others.
    lz.land_batches(source.where(F.col("batch_date") == day(6)), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(6)) == {day(2), day(6)}
    assert read_mart(spark, cfg.warehouse).where("is_duplicate").count() == 0
    # Time passes: the order dated ahead is no longer in the future.
    assert rebuilt(spark, cfg, day(20)) == {day(1)}
    # A customer that only one day knows is added.
    stranger = source.where("order_id = 'o200'").withColumn("customer_id", F.lit("c9"))
    lz.land_batches(source.where(f"batch_date = '{day(3)}' and order_id <> 'o200'").unionByName(stranger), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(20), compare=False) == {day(3)}
    lz.land_dimension(customers.union(spark.createDataFrame([("c9", "n9", "e9", "2024-01-01", "EU")], customers.schema)), cfg.landing, "customers")
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(20)) == {day(3)}
    assert read_mart(spark, cfg.warehouse).where("is_orphan_order").count() == 0


def test_keys_of_changed_days_are_not_looked_up(spark, customers, products, source, tmp_path, monkeypatch):
    cfg = config(tmp_path, None)
    pl.run_backfill(spark, cfg, source, customers, products, day(5))
    copy = source.where("order_id = 'o130'").withColumn("batch_date", F.lit(day(6)))
    lz.land_batches(source.where(F.col("batch_date") == day(6)).unionByName(copy), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    looked_up, with_keys = [], mart_table._with_keys

    def recorded(orders, keys, key):
        looked_up.append((key, {r.batch_date for r in orders.select("batch_date").distinct().collect()}))
        return with_keys(orders, keys, key)

    monkeypatch.setattr(mart_table, "_with_keys", recorded)
    assert rebuilt(spark, cfg, day(6), compare=False) == {day(2), day(6)}
    old = {day(n) for n in range(6)}
    assert looked_up[:3] == [("order_id", old), ("customer_id", old), ("product_id", old)]


def test_rows_without_an_order_id_and_days_without_rows(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, None)
    bare = F.when(F.col("order_id").isin("o10", "o70"), F.lit(None)).otherwise(F.col("order_id"))
    source = source.withColumn("order_id", bare)
    with pytest.raises(quality.PipelineGateError, match="not_null"):
        pl.run_backfill(spark, cfg, source.where(F.col("batch_date") != day(0)), customers, products, day(3))
    lz.land_batches(source.where(F.col("batch_date") == day(0)), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(3)) == {day(0), day(1)}
    assert read_mart(spark, cfg.warehouse).where("order_id is null and is_duplicate").count() == 1
    # All lines of a day turn bad.
    broken = spark.createDataFrame([("x", day(2))], "order_id string, batch_date date")
    write_daily(broken, f"{cfg.landing}/orders", "csv", cluster=True, header="true")
    run_load(spark, cfg.landing, cfg.warehouse)
    assert rebuilt(spark, cfg, day(3)) == {day(2)}
    assert read_mart(spark, cfg.warehouse).where(F.col("batch_date") == day(2)).count() == 0


def test_where_all_days_changed_no_rows_are_looked_up(spark, customers, products, source, tmp_path, monkeypatch):
    cfg = config(tmp_path, None)
    few = source.where(F.col("batch_date") <= day(2))
    pl.run_backfill(spark, cfg, few, customers, products, day(2))
    lz.land_batches(few.withColumn("status", F.lit("SHIPPED")), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)

    def refuse(*_):
        raise AssertionError("looked for rows that are all rebuilt anyway")

    monkeypatch.setattr(mart_table, "_with_keys", refuse)
    assert rebuilt(spark, cfg, day(2)) == {day(0), day(1), day(2)}
    assert read_mart(spark, cfg.warehouse).where("status = 'SHIPPED'").count() == 180


class Died(Exception):
    pass


def test_a_build_that_dies_changes_nothing(spark, customers, products, source, tmp_path, monkeypatch):
    """In whatever step it dies, readers have the old version, and the next build makes up for it."""
    cfg = config(tmp_path, None)
    pl.run_backfill(spark, cfg, source, customers, products, day(2))
    old, feed = rows_of(read_mart(spark, cfg.warehouse)), rows_of(read_feed(spark, cfg.warehouse))
    copy = source.where("order_id = 'o130'").withColumn("batch_date", F.lit(day(3)))
    lz.land_batches(source.where(F.col("batch_date") == day(3)).unionByName(copy), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    write, steps = Versions.write, []

    for dies_at in range(6):
        steps.clear()

        def failing(self, rows, table, *rest):
            if len(steps) == dies_at:  # noqa: B023
                raise Died(table)
            steps.append(table)
            return write(self, rows, table, *rest)

        def unpublished(self, spark, manifest):
            raise Died("publish")

        monkeypatch.setattr(Versions, "write", failing)
        if dies_at == 5:
            monkeypatch.setattr(Versions, "publish", unpublished)
        with pytest.raises(Died):
            pl.build_models(spark, cfg.warehouse, day(3))
        monkeypatch.undo()
        assert rows_of(read_mart(spark, cfg.warehouse)) == old and rows_of(read_feed(spark, cfg.warehouse)) == feed
    assert steps == ["rows", "cells", "feed", "customers", "products"]
    assert rebuilt(spark, cfg, day(3)) == {day(2), day(3)}
    assert mart_versions(cfg.warehouse).vacuum(spark, 1, orphans=True) > 0
    assert read_mart(spark, cfg.warehouse).count() == 241 and read_mart(spark, cfg.warehouse).where("is_duplicate").count() == 1


def test_rows_are_stored_before_they_are_dealt_by_day(spark, customers, products, source, tmp_path, monkeypatch):
    """Else what they were dealt for by id, customer and product lies on the disks beside it."""
    cfg = config(tmp_path, None)
    plans, write = {}, Versions.write

    def noted(self, rows, table, *rest):
        plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        if fails and table == "rows":
            raise Died(table)
        return write(self, rows, table, *rest)

    monkeypatch.setattr(Versions, "write", noted)
    for fails in (True, False):
        if fails:
            with pytest.raises(Died):
                pl.run_backfill(spark, cfg, source, customers, products, day(2))
        else:
            pl.run_backfill(spark, cfg, source, customers, products, day(2))
        assert "Window" not in plans["rows"] and "Join" not in plans["rows"]
        assert not list(tmp_path.glob("house/fct_orders/flagged/*"))
    assert read_mart(spark, cfg.warehouse).count() == 180


def test_a_reader_keeps_its_version_while_builds_go_on(spark, customers, products, source, tmp_path):
    cfg = config(tmp_path, None)
    pl.run_backfill(spark, cfg, source, customers, products, day(2))
    pinned = mart_versions(cfg.warehouse).numbers(spark)[-1]
    mart, feed = read_mart(spark, cfg.warehouse, pinned), read_feed(spark, cfg.warehouse, pinned)
    before = rows_of(mart), rows_of(feed)
    # All of day 1 goes, day 2 is another one, day 3 is new: its folders stay for the reader.
    changed = source.where(F.col("batch_date") == day(2)).withColumn("status", F.lit("SHIPPED"))
    lz.land_batches(changed.unionByName(source.where(F.col("batch_date") == day(3))), cfg.landing)
    shutil.rmtree(f"{cfg.landing}/orders/batch_date={day(1)}")
    shutil.rmtree(f"{cfg.warehouse.orders}/batch_date={day(1)}")
    run_load(spark, cfg.landing, cfg.warehouse)
    pl.build_models(spark, cfg.warehouse, day(3))
    assert (rows_of(mart), rows_of(feed)) == before
    now = read_mart(spark, cfg.warehouse)
    assert {r.batch_date for r in now.select("batch_date").distinct().collect()} == {day(0), day(2), day(3)}
    assert rows_of(live_feed(spark, cfg.warehouse.mart)) == rows_of(daily_status_rollup(now))


def test_a_day_is_merged_from_the_cells_of_all(spark, customers, products, source, tmp_path, monkeypatch):
    """One more day: the rows of that day alone are written, and read for the feed."""
    cfg = config(tmp_path, None)
    pl.run_backfill(spark, cfg, source, customers, products, day(4))
    lz.land_batches(source.where(F.col("batch_date") == day(5)), cfg.landing)
    run_load(spark, cfg.landing, cfg.warehouse)
    seen, read = [], Versions.read

    def noted(self, spark, manifest, table, *rest):
        seen.append((table, len(manifest.folders.get(table, []))))
        return read(self, spark, manifest, table, *rest)

    monkeypatch.setattr(Versions, "read", noted)
    pl.build_models(spark, cfg.warehouse, day(5))
    monkeypatch.undo()
    # The rows of the old version are opened by the days that changed in it; of the new one, its own day's.
    assert [n for table, n in seen if table == "rows"][:2] == [5, 1]
    assert [n for table, n in seen if table == "cells"] == [5, 6]
    assert rows_of(read_feed(spark, cfg.warehouse)) == rows_of(daily_status_rollup(read_mart(spark, cfg.warehouse)))
