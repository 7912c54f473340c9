"""Seeding is exact, repeatable and found again by the detectors."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trustline.operators import defects
from trustline.operators import duplicates as dup
from trustline.operators.ranking import row_number_within
from trustline.plans.catalog import Tables
from trustline.sources import testdata as td


@pytest.fixture(scope="module")
def tables(spark, sf):
    return Tables(spark, sf)


@pytest.fixture(scope="module")
def batches(spark):
    """Three batches of 100, 30 and 5 rows."""
    sizes = spark.createDataFrame([("2024-01-01", 100), ("2024-01-02", 30), ("2024-01-03", 5)], "d string, n int")
    rows = sizes.select(F.col("d").cast("date").alias("batch_date"), F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    return rows.select(
        "batch_date",
        F.concat_ws("-", "batch_date", "i").alias("order_id"),
        F.lit("c").alias("customer_id"),
        F.lit("p").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(10.0).alias("total_amount"),
        F.col("batch_date").alias("order_date"),
        F.lit("PENDING").alias("status"),
        F.col("i").cast("bigint").alias("row_id"),
    )


def test_seeding_is_repeatable(batches):
    seed = lambda: sorted(map(repr, defects.seed_all(batches, ["order_id"], "batch_date").collect()))
    assert seed() == seed()


def test_markers_name_the_changed_rows(batches):
    seeded = defects.seed_defects(batches, ["order_id"], rate=1.0, as_of="2024-01-10", markers=True)
    rows = seeded.collect()
    assert {r.customer_id for r in rows if r.seeded_null} == {None}
    assert {r.customer_id for r in rows if r.seeded_ghost and not r.seeded_null} == {"ghost-c"}
    assert {r.total_amount for r in rows} == {10.0, -10.0, 15.0, -15.0}
    future = dt.date(2024, 1, 10) + dt.timedelta(days=10_000)
    assert {r.order_date for r in rows if r.seeded_future} == {future}
    assert {r.status for r in rows if r.seeded_typo} <= set(defects.STATUS_TYPOS)
    assert {r.status for r in rows if not r.seeded_typo} == {"PENDING"}


def draws(batches, rate):
    return {r._batch: r._draw for r in defects.batch_draws(batches, "neg", "batch_date", rate).collect()}


@pytest.mark.parametrize("min_rows", [10**6, 20])
def test_exact_counts_per_batch(batches, min_rows):
    hot = dup.hot_buckets(batches, "batch_date", min_rows=min_rows)
    seeded = defects.seed_exact(batches, "neg", ["order_id"], "batch_date", 0.5, hot=hot)
    negative = F.count_if(F.col("total_amount") < 0).alias("n")
    hit = {r.batch_date: r.n for r in seeded.groupBy("batch_date").agg(negative).collect()}
    expected = draws(batches, 0.5)
    assert hit == expected and seeded.count() == 135
    assert all(0 <= n <= most for n, most in zip([hit[k] for k in sorted(hit)], (50, 15, 2)))


@pytest.mark.parametrize("min_rows", [10**6, 20])
def test_exact_draws_are_those_of_the_plain_window(batches, min_rows, monkeypatch):
    """Also of a NULL batch, and of rows alike in all; only the slices in which draws end are ranked."""
    bare = batches.withColumn("batch_date", F.when(F.col("batch_date") > "2024-01-01", F.col("batch_date")))
    alike = batches.withColumns({"order_id": F.lit("o"), "row_id": F.lit(1).cast("bigint")})
    ranked = []
    monkeypatch.setattr(defects, "row_number_within", lambda df, *a: ranked.append(df.count()) or row_number_within(df, *a))
    for rows, keys in ((bare, ["order_id"]), (alike, ["order_id"])):
        hot = dup.hot_buckets(rows, "batch_date", min_rows=min_rows)
        picked = defects.pick_exact(rows, "neg", keys, "batch_date", 0.5, [], hot)
        assert picked.columns == [*rows.columns, "_hit"] and picked.drop("_hit").exceptAll(rows).isEmpty() and picked.count() == 135
        hit = {r.batch_date: r.n for r in picked.groupBy("batch_date").agg(F.count_if("_hit").alias("n")).collect()}
        assert hit == draws(rows, 0.5)
        if rows is bare:
            number = F.row_number().over(Window.partitionBy("batch_date").orderBy(defects.tagged_hash("neg", keys)))
            drawn = defects.batch_draws(rows, "neg", "batch_date", 0.5)
            plain = rows.withColumn("_n", number).join(drawn, F.col("batch_date").eqNullSafe(F.col("_batch"))).where("_n <= _draw")
            assert {r.order_id for r in plain.collect()} == {r.order_id for r in picked.where("_hit").collect()}
            assert not ranked or ranked[0] < 27
    assert bool(ranked) == (min_rows == 20)


def test_copies_are_full_rows_and_at_most_five(batches):
    copies = defects.copies_to_add(batches, ["order_id"], "batch_date")
    assert copies.columns == batches.columns
    assert copies.exceptAll(batches).isEmpty()
    assert all(r["count"] <= 5 for r in copies.groupBy("batch_date").count().collect())
    seeded = defects.seed_duplicates(batches, ["order_id"], "batch_date")
    assert seeded.count() == 135 + copies.count()


def test_only_five_rows_per_batch_are_shuffled(batches):
    plan = defects.copies_to_add(batches, ["order_id"], "batch_date")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_recall(tables):
    seeded = defects.seed_all(tables.base, td.SEED_KEYS, "batch_date", as_of=td.AS_OF, markers=True)
    report = defects.detector_recall(seeded, tables.stg_customers, tables.stg_products, td.AS_OF)
    recall = {r.defect: (r.seeded, r.detected) for r in report.collect()}
    for defect, (count, found) in recall.items():
        assert count > 0
        if defect == "typo":  # upper case repairs one of the five typos
            assert 0.6 * count < found < count
        else:
            assert found == count
