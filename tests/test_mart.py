"""The mart on hand-made rows: NULL rules, duplicates, fan-out, and skewed keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trustline.functions import flags
from trustline.operators import duplicates as dup
from trustline.operators import mart, rollup
from trustline.operators import ranking
from trustline.operators.ranking import row_number_within
from trustline.sources import schemas

AS_OF = dt.date(2024, 6, 30)


def orders(spark, *rows):
    """(order_id, customer_id, product_id, quantity, total_amount, order_date, status)."""
    return spark.createDataFrame(list(rows), schemas.STG_ORDERS)


def order(order_id="o1", customer="c1", product="p1", quantity=2, total=20.0, date=AS_OF, status="PENDING"):
    return (order_id, customer, product, quantity, total, date, status)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("c1", "Ann", "a@x", "EU", None)], schemas.STG_CUSTOMERS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("p1", "Cup", "Home", 10.0, 3)], schemas.STG_PRODUCTS)


def build(spark, customers, products, *rows):
    return mart.fct_orders(orders(spark, *rows), customers, products, AS_OF)


def set_flags(row):
    return {f for f in flags.FLAGS if row[f]}


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, set()),
        ({"customer": None}, {"is_orphan_order"}),
        ({"customer": "ghost"}, {"is_orphan_order"}),
        ({"total": -20.0}, {"has_negative_amount", "has_math_error"}),
        ({"total": 30.0}, {"has_math_error"}),
        ({"total": None}, set()),
        ({"quantity": None}, set()),
        ({"product": "unknown"}, set()),
        ({"date": AS_OF + dt.timedelta(days=1)}, {"is_future_order"}),
        ({"date": None}, set()),
        ({"status": None}, {"has_bad_status"}),
        ({"status": "SHIPPED!"}, {"has_bad_status"}),
    ],
)
def test_flags(spark, customers, products, change, expected):
    (row,) = build(spark, customers, products, order(**change)).collect()
    assert set_flags(row) == expected
    assert all(row[f] is not None for f in flags.FLAGS)


def test_schema(spark, customers, products):
    built = build(spark, customers, products, order())
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in schemas.FCT_ORDERS]


def test_unknown_product_has_no_price(spark, customers, products):
    (row,) = build(spark, customers, products, order(product="unknown")).collect()
    assert row.unit_price is None and row.product_name is None


def test_duplicate_with_unknown_date_is_the_later_one(spark, customers, products):
    rows = build(spark, customers, products, order(date=None), order(date=dt.date(2024, 1, 1))).collect()
    assert {(r.order_date is None, r.is_duplicate) for r in rows} == {(True, True), (False, False)}


def test_unknown_order_ids_are_one_group(spark, customers, products):
    rows = build(spark, customers, products, *[order(order_id=None)] * 3, order(order_id="")).collect()
    assert sorted((str(r.order_id), r.is_duplicate) for r in rows) == [
        ("", False), ("None", False), ("None", True), ("None", True),
    ]


def test_repeated_customer_fans_out_and_is_flagged(spark, customers, products):
    rows = build(spark, customers.union(customers), products, order()).collect()
    assert sorted(r.is_duplicate for r in rows) == [False, True]


def test_default_as_of_is_today(spark, customers, products):
    tomorrow = dt.date.today() + dt.timedelta(days=2)
    (row,) = mart.fct_orders(orders(spark, order(date=tomorrow)), customers, products).collect()
    assert row.is_future_order


def test_clean_and_dirty_make_the_whole(spark, customers, products):
    built = build(spark, customers, products, order(), order(), order("o2", status="x"), order("o3"))
    assert mart.clean_orders(built).count() == 2 and mart.dirty_orders(built).count() == 2
    feed = rollup.daily_status_rollup(built)
    assert feed.agg(F.sum("order_count"), F.sum("total_revenue")).first() == (4, 80.0)
    assert rollup.clean_revenue_by_date(built).first().clean_revenue == 40.0


def test_group_of_unknown_amounts_sums_to_null(spark, customers, products):
    feed = rollup.daily_status_rollup(build(spark, customers, products, order(total=None)))
    assert feed.first().total_revenue is None


def test_derive_order_total(spark, products):
    lines = spark.createDataFrame([("l1", "p1", 3), ("l2", "none", 1)], "id string, product_id string, quantity int")
    assert [(r.id, r.total_amount) for r in mart.derive_order_total(lines, products).collect()] == [("l1", 30.0)]


# --- skew -----------------------------------------------------------------------------


def skewed(spark, copies=False):
    """300 rows: a third with one order id, a third without any, the rest nearly unique."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"o{rng.randrange(70)}"
        if copies and i % 3 < 2:
            rows.append((i, *order(key)))
            continue
        date = rng.choice([None, dt.date(2024, 1, rng.randrange(1, 28))])
        customer, total = rng.choice(["c1", None]), rng.choice([20.0, None])
        rows.append((i, *order(key, customer, f"p{rng.randrange(4)}", 2, total, date)))
    names = ["row_id", *schemas.STG_ORDERS.names]
    return spark.createDataFrame(rows, "row_id bigint, " + ddl(schemas.STG_ORDERS)).select(*names)


def ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def content(df, *extra):
    return sorted(map(repr, df.select(*schemas.STG_ORDERS.names, *extra).collect()))


@pytest.mark.parametrize("copies", [False, True])
def test_hot_keys_give_the_same_duplicates(spark, copies):
    df = skewed(spark, copies)
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    assert hot.count() == 2 and hot.agg(F.max("_salts")).first()[0] >= 5
    salted = dup.flag_repeats(df, "order_id", mart.FIRST_ROW, "again", hot)
    plain = dup.flag_repeats(df, "order_id", mart.FIRST_ROW, "again", hot.limit(0))
    assert content(salted, "again") == content(plain, "again")
    firsts = salted.where(~F.col("again")).groupBy("order_id").count()
    assert firsts.where("count != 1").isEmpty()
    assert firsts.count() == df.select("order_id").distinct().count()


def test_hot_keys_without_row_identity(spark):
    df = skewed(spark).drop("row_id")
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    salted = dup.flag_repeats(df, "order_id", mart.FIRST_ROW, "again", hot)
    plain = dup.flag_repeats(df, "order_id", mart.FIRST_ROW, "again", hot.limit(0))
    assert content(salted, "again") == content(plain, "again")


def test_hot_group_is_spread(spark):
    df = skewed(spark, copies=True)
    salted = dup.with_salt(df, "order_id", dup.hot_buckets(df, "order_id", min_rows=20))
    largest = salted.groupBy("_key", "_key_null", "_salt").count().agg(F.max("count")).first()[0]
    assert largest <= 40  # of 100 copies


def test_no_hot_buckets_in_an_even_table(spark):
    ids = spark.range(100000).select(F.col("id").cast("string").alias("order_id"))
    assert dup.hot_buckets(ids, "order_id").isEmpty()


def test_hot_mart_equals_plain_mart(spark, customers, products):
    df = skewed(spark)
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    built = mart.fct_orders(df, customers, products, AS_OF, hot)
    plain = mart.fct_orders(df, customers, products, AS_OF, hot.limit(0))
    assert sorted(map(repr, built.collect())) == sorted(map(repr, plain.collect()))
    assert built.count() == 300


def test_row_numbers_of_hot_keys_are_complete_and_in_date_order(spark):
    df = skewed(spark)
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    rows = row_number_within(df, "order_id", mart.FIRST_ROW, "n", hot=hot).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.order_id, []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: r.n)
        assert [r.n for r in members] == list(range(1, len(members) + 1))
        days = [r.order_date or dt.date.max for r in members]
        assert days == sorted(days)
    assert len(rows) == 300


def test_row_numbers_by_hash_digit(spark):
    df = spark.range(500).select("id", F.lit("k").alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    hot = dup.hot_buckets(df, "k", min_rows=400)
    rows = row_number_within(df, "k", dup.Ordering(("h",)), "n", hot).collect()
    rows.sort(key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(1, 501))
    digits = [r.h[:3] for r in rows]
    assert digits == sorted(digits)
    plain = row_number_within(df, "k", dup.Ordering(("h",)), "n", hot.limit(0)).collect()
    hashes = [r.h for r in sorted(plain, key=lambda r: r.n)]
    assert hashes == sorted(hashes)


def test_row_numbers_put_unknown_dates_last(spark):
    days = spark.sql("select 1 k, date'2024-01-02' d union all select 1, null union all select 1, date'1969-12-31'")
    for threshold in (1, 10):
        hot = dup.hot_buckets(days, "k", min_rows=threshold)
        rows = row_number_within(days, "k", dup.Ordering(("d",)), "n", hot).orderBy("n").collect()
        assert [r.d for r in rows] == [dt.date(1969, 12, 31), dt.date(2024, 1, 2), None]


@pytest.mark.parametrize("threshold", [1, 10, 1000])
@pytest.mark.parametrize("kind", ["string", "int", "date"])
def test_row_numbers_are_those_of_the_plain_window(spark, threshold, kind):
    """Whatever counts as hot, for keys of any type with NULLs, and with ties in most of the tuple."""
    key = {"string": "concat('k', id % 3)", "int": "int(id % 3)", "date": "date_add(date'2024-01-01', int(id % 3))"}[kind]
    df = spark.range(600).selectExpr(f"if(id % 4 = 0, null, {key}) k", "if(id % 7 = 0, null, id % 5) a", "md5(string(id % 50)) h", "id row_id")
    order = dup.Ordering(("a", "h", "row_id"))
    hot = dup.hot_buckets(df, "k", min_rows=threshold)
    got = row_number_within(df, "k", order, "n", hot)
    assert got.schema["k"].dataType == df.schema["k"].dataType
    w = Window.partitionBy("k").orderBy(*order.window_order())
    want = df.withColumn("n", F.row_number().over(w))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    again = dup.flag_repeats(df, "k", order, "again", hot)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, want.withColumn("n", F.col("n") > 1).withColumnRenamed("n", "again").collect()))


def test_identical_rows_spread_over_their_salts(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    hot = dup.hot_buckets(df, "k", min_rows=100)
    groups = dup.with_salt(df, "k", hot).groupBy("_salt").count().collect()
    assert len(groups) == 30 and max(r["count"] for r in groups) < 200
    numbers = [r.n for r in row_number_within(df, "k", dup.Ordering(("v",)), "n", hot).collect()]
    assert sorted(numbers) == list(range(1, 3001))
    assert dup.flag_repeats(df, "k", dup.Ordering(("v",)), "again", hot).where("not again").count() == 1


def test_ranges_of_a_hot_key_are_bounded_and_in_order(spark):
    """One key with a third of the rows, half of which are equal in the whole ordering tuple."""
    df = spark.range(9000).selectExpr("if(id % 3 = 0, null, id) k", "if(id % 6 = 0, 0, id) v", "id row_id")
    order = dup.Ordering(("v",))
    hot = dup.hot_buckets(df, "k", min_rows=500)
    assert [r[0] for r in ranking.hot_keys(df, "k", hot).collect()] == [None]
    ranged = ranking.in_ranges(df.where("k is null"), "k", order, 8).cache()
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("_range").collect()
    assert len(sizes) > 4 and max(r.n for r in sizes) < 3000 / 2
    assert all(a.high <= b.low for a, b in zip(sizes, sizes[1:], strict=False))
    ranged.unpersist()
    got = row_number_within(df, "k", order, "n", hot)
    assert got.where("k is null").agg(F.countDistinct("n"), F.min("n"), F.max("n")).first()[:] == (3000, 1, 3000)
    assert got.where("k is not null and n = 1").count() == 6000


def test_row_numbers_of_an_empty_table(spark):
    empty = spark.range(0).selectExpr("id k", "id v")
    assert row_number_within(empty, "k", dup.Ordering(("v",)), "n").collect() == []


def test_an_order_with_several_dimension_rows_has_one_first_row(spark, customers, products):
    """Repeated keys, rows alike among them, fan orders out; neither hashes nor attributes pass the window for it."""
    df = skewed(spark)
    name = customers.withColumn("name", F.concat(F.lit("other "), "name"))
    several = customers.unionByName(customers).unionByName(name)
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    for h in (hot, hot.limit(0)):
        built = mart.fct_orders(df, several, products, AS_OF, h)
        firsts = built.where("not is_duplicate").groupBy("order_id").count()
        assert firsts.where("count != 1").isEmpty()
        assert firsts.count() == df.select("order_id").distinct().count()
    assert "_customer#" in built._jdf.queryExecution().optimizedPlan().toString()
    shuffled = mart.flagged_orders(df, several, products, AS_OF, hot.limit(0)).select("order_id", "is_duplicate")
    kinds = {f.name: f.dataType.simpleString() for f in mart._ranked(several, "customer_id", "_customer", "name").schema}
    assert kinds["_customer"] == "boolean" and shuffled.count() == built.count()


def test_products_before_or_after_the_window_make_the_same_mart(spark, customers, products):
    df = skewed(spark).withColumns({"customer_id": F.lit("c1"), "product_id": F.lit("p1")})
    several = customers.unionByName(customers.withColumn("name", F.lit("other")))
    twice = products.unionByName(products).unionByName(products.withColumn("price", F.lit(2.0)))
    hot = dup.hot_buckets(df, "order_id", min_rows=20)
    for h in (hot, hot.limit(0)):
        first, after = [mart.flagged_orders(df, several, twice, AS_OF, h, ("quantity", "row_id"), products_first=p) for p in (True, False)]
        assert first.count() == 6 * df.count() and first.exceptAll(after).isEmpty() and after.exceptAll(first).isEmpty()
        assert first.where("not is_duplicate").count() == df.select("order_id").distinct().count()
