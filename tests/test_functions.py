"""Casts, NULL markers and status rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trustline.functions import casts, flags
from trustline.functions.hashing import selected


def column(spark, values, expression, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_safe_int(spark):
    texts = ["3", "3.7", "2.5", "-2.5", " 4 ", "x", "", "1e3", "99999999999", None]
    assert column(spark, texts, casts.safe_int) == [3, 4, 3, -3, 4, None, None, 1000, None, None]


def test_safe_double(spark):
    texts = ["1.5", "-2", "1e2", " 7 ", "x", "", "1.5d", "2f", "0x1p3", ".5", None]
    assert column(spark, texts, casts.safe_double) == [
        1.5, -2.0, 100.0, 7.0, None, None, None, None, None, 0.5, None,
    ]


def test_safe_date(spark):
    others = [
        "2024-1-5", "2024", "2024-01-05 10:00:00", "2024-02-30", "not-a-date", None,
        "2024-1-5 1", "2024-1-05T", "+2024-1-05", " 202-01-05", "2024/01/05", "",
    ]
    assert column(spark, ["2024-01-05", *others], casts.safe_date) == [dt.date(2024, 1, 5)] + [None] * 12


def test_null_markers(spark):
    assert column(spark, ["NULL", "null", "", "Null", "a", None], casts.null_marker) == [
        None, None, None, "Null", "a", None,
    ]


def test_normalise_only_named_columns(spark):
    df = spark.createDataFrame([("NULL", "NULL")], "a string, b string")
    assert casts.normalise_null_markers(df, ["a"]).first() == (None, "NULL")
    assert casts.normalise_null_markers(df).first() == (None, None)


def test_lowercase_columns(spark):
    assert casts.lowercase_columns(spark.range(1).toDF("ID")).columns == ["id"]


def test_bad_status_after_upper(spark):
    texts = [None, "completed", "Shipped!", "CANCELLED"]
    assert column(spark, texts, lambda c: flags.bad_status(F.upper(c))) == [True, False, True, False]


def test_status_bucket(spark):
    assert column(spark, ["PENDING", "pending", None], flags.status_bucket) == [
        "PENDING", "INVALID/DIRTY", "INVALID/DIRTY",
    ]


@pytest.mark.parametrize("total, expected", [(20.04, False), (20.06, True), (19.9, True), (None, False)])
def test_math_error_tolerance(spark, total, expected):
    expression = flags.math_error(F.lit(total).cast("double"), F.lit(2), F.lit(10.0))
    assert spark.range(1).select(expression.alias("x")).first().x is expected


def test_unknown_price_is_no_math_error(spark):
    expression = flags.math_error(F.lit(5.0), F.lit(2), F.lit(None).cast("double"))
    assert spark.range(1).select(expression.alias("x")).first().x is False


def test_selection_share_and_independence(spark):
    ids = spark.range(20000)
    both = ids.select(selected("a", ["id"], 0.25).alias("a"), selected("b", ["id"], 0.25).alias("b"))
    n = both.agg(F.count_if("a"), F.count_if("b"), F.count_if(F.col("a") & F.col("b"))).first()
    assert abs(n[0] / 20000 - 0.25) < 0.02 and abs(n[1] / 20000 - 0.25) < 0.02
    assert abs(n[2] / 20000 - 0.0625) < 0.01
    assert ids.where(selected("a", ["id"], 1.0)).count() == 20000
    assert ids.where(selected("a", ["id"], 0.0)).count() == 0


def test_integers_are_rounded_once(spark):
    texts = ["2.49999999999", "2.5", "-2.5", "-2.49999999999999", ".5", "0.", "1e3", "2.5e0", "99999999999", "NaN", "Infinity", ".", "+7.5"]
    assert column(spark, texts, casts.safe_int) == [2, 3, -3, -2, 1, 0, 1000, 3, None, None, None, None, 8]


def test_doubles_are_finite(spark):
    assert column(spark, ["NaN", "Infinity", "-inf", "1e400", "-1e400", "1e300"], casts.safe_double) == [None] * 5 + [1e300]
