"""Row numbers within a key whose rows may be a third of the table.

Keys with more rows than a bucket may have (see ``duplicates``) are hot; there are 32,768 at
most.  Rows of all other keys are numbered by the plain window.  Those of hot keys are dealt
by ranges of (key, whole ordering tuple) and sorted there, so that a row's place in its
partition is known without a window.  They are stored with it: the ranges are drawn once, and
numbers and offsets rest on the same ones.  A row's number is its place among the key's rows
in its partition, plus the key's rows in the partitions before, counted per (partition, key).

Rows that are equal in the whole tuple are told apart by their identity, so they are spread,
too.  What is called hot changes no number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustline.operators import duplicates as dup
from trustline.sources.tables import materialise, scratch_folder

# monotonically_increasing_id() is the partition times this, plus the place in it.
_PLACES = 1 << 33


def hot_keys(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """(_hot_key): keys of hot buckets that alone have more rows than ``_floor``, NULL included."""
    salted = dup.with_salt(df.select(key), key, hot, keep_floor=True).where("_hot")
    counts = salted.groupBy("_key", "_key_null").agg(F.count("*").alias("_n"), F.max("_floor").alias("_most"))
    return counts.where("_n > _most").select(F.when(~F.col("_key_null"), F.col("_key")).alias("_hot_key"))


def in_ranges(df: DataFrame, key: str, order: dup.Ordering, n: int) -> DataFrame:
    """The rows in ``n`` ranges of (key, order), each sorted, with ``_range`` and their ``_place`` in it."""
    within = [F.col(key).asc_nulls_last(), *order.window_order(), F.col("_tie")]
    dealt = df.withColumn("_tie", F.xxhash64(dup.identity(df))).repartitionByRange(n, *within).sortWithinPartitions(*within)
    at = dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    place = F.col("_at") % _PLACES
    return at.withColumns({"_range": F.floor(F.col("_at") / _PLACES).cast("int"), "_place": place}).drop("_at")


def range_offsets(ranged: DataFrame, key: str) -> DataFrame:
    """(_in, _of, _offset): what to add to a place to get the row's number, per range and key.

    Ranges plus keys bound its rows; the window runs over one key's ranges, not its rows.
    """
    spans = ranged.groupBy(F.col("_range").alias("_in"), F.col(key).alias("_of")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select("_in", "_of", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_offset"))


def _is(key: str, other: str) -> Column:
    return F.col(key).eqNullSafe(F.col(other))


def row_number_within(df: DataFrame, key: str, order: dup.Ordering, name: str, hot: DataFrame | None = None) -> DataFrame:
    """Add ``name``: the row's number among the rows of ``key``, in ``order``, NULLs last.

    Counts the keys when called; where some are hot, their rows are stored in shared storage.
    """
    spark = df.sparkSession
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order.window_order())).cast("long")
    hot = hot if hot is not None else dup.hot_buckets(df, key)
    slices = hot.agg(F.sum("_salts")).first()[0]
    if not slices:
        return df.withColumn(name, plain)
    root = scratch_folder(spark, "ranks")
    keys = F.broadcast(materialise(hot_keys(df, key, hot), f"{root}/keys"))
    n = min(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialise(in_ranges(df.join(keys, _is(key, "_hot_key"), "left_semi"), key, order, n), f"{root}/rows")
    offsets = F.broadcast(range_offsets(ranged, key))
    placed = ranged.join(offsets, (F.col("_range") == F.col("_in")) & _is(key, "_of"))
    numbered = placed.withColumn(name, F.col("_place") + F.col("_offset")).select(*df.columns, name)
    rest = df.join(keys, _is(key, "_hot_key"), "left_anti").withColumn(name, plain)
    return rest.unionByName(numbered)
