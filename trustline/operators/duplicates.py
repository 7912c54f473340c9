"""Second-and-later rows of a key, found without putting one key in one task.

``row_number() over (partition by key)`` sends every row of a key to the same
task, so a key with a third of the table (all NULL keys are such a group, too)
would never finish.  Only the *first* row of each key is special, so the work
splits:

1. count rows per hash bucket of the key: a fixed number of buckets, combined
   map-side, one column read.  A bucket far above an even share is hot;
2. rows of hot buckets get a salt from their row identity, so that the window
   runs over (key, salt) groups of bounded size.  All others have salt 0;
3. for hot buckets alone, ``min(struct(order, salt))`` per key names the salt
   group that holds the true first row.  It is a map-side-combined aggregate.
   A row is the first of its key when it is first in its group and that group
   is the named one.

The buckets are counted when the query is built.  Without hot ones there is neither
salt nor step 3; what remains is the plain window.  With them step 3 reads rows of hot
buckets only, and its join reuses the window's partitioning, so the wide rows are
shuffled once in either case.  The outcome never depends on which buckets were called hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 65536
HOT_ROWS = 1_000_000
# Hot buckets that are named in a filter, which reaches the scan below joins; more of them are joined only.
FEW_BUCKETS = 4096


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def hot_buckets(keys: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """(_bucket, _salts, _floor): buckets with over ``min_rows`` rows and twice an even share.

    ``_floor`` is how many rows a bucket may have before it counts as hot.

    At most ``BUCKETS / 2`` rows of three numbers whatever the table's size, which is
    the bound that allows broadcasting it.
    """
    counts = keys.groupBy(_bucket(key).alias("_bucket")).agg(F.count("*").alias("_n"))
    # The total is taken over the counts, at most BUCKETS rows; the keys are read once.
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    return (
        counts.withColumn("_floor", F.greatest(F.lit(min_rows).cast("bigint"), F.ceil(2 * total / BUCKETS)))
        .where(F.col("_n") > F.col("_floor"))
        .select("_bucket", F.ceil(F.col("_n") / F.col("_floor")).alias("_salts"), "_floor")
    )


def found(hot: DataFrame) -> DataFrame | None:
    """The hot buckets, counted now and only once; None where there are none."""
    rows = hot.collect()
    return hot.sparkSession.createDataFrame(rows, hot.schema) if rows else None


@dataclass(frozen=True)
class Ordering:
    """Columns that rank the rows of a key, NULLs last."""

    columns: tuple[str, ...]

    def window_order(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in self.columns]

    def sort_key(self) -> list[Column]:
        """The same order as struct fields: structs compare NULL first, so lead with the test."""
        fields = []
        for c in self.columns:
            fields += [F.col(c).isNull().alias(f"_{c}_null"), F.col(c).alias(f"_{c}")]
        return fields


_FILLERS = {
    "string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "timestamp_ntz": "1970-01-01 00:00:00",
    "boolean": False, "binary": b"",
}


def _filler(kind: T.DataType) -> Column:
    """A value of the key's own type to stand in for NULL, beside ``_key_null``."""
    return F.lit(0 if isinstance(kind, T.NumericType) else _FILLERS[kind.typeName()]).cast(kind)


def identity(df: DataFrame) -> Column:
    """What tells rows apart that are alike: ``row_id``, else their place in the scan."""
    return F.col("row_id") if "row_id" in df.columns else F.monotonically_increasing_id()


def with_salt(df: DataFrame, key: str, hot: DataFrame | None, keep_floor: bool = False) -> DataFrame:
    """Add the grouping columns ``_key``, ``_key_null``, ``_salt`` and drop ``key``.

    With no hot buckets the key becomes ``_key`` and is the only grouping column.

    Rows are told apart by ``row_id`` where the frame has one.  Without it their place in
    the scan does, which needs a frame that is read from storage, so that it is the same
    whenever the rows are read.
    """
    if hot is None:
        return df.withColumnRenamed(key, "_key")
    salt = F.coalesce(F.pmod(F.xxhash64(identity(df)), F.col("_salts")), F.lit(0).cast("bigint"))
    return (
        df.withColumn("_bucket", _bucket(key))
        .join(F.broadcast(hot), "_bucket", "left")
        .withColumn("_salt", salt)
        .withColumn("_hot", F.col("_salts").isNotNull())
        .withColumn("_key", F.coalesce(F.col(key), _filler(df.schema[key].dataType)))
        .withColumn("_key_null", F.col(key).isNull())
        .drop("_bucket", "_salts", key, *([] if keep_floor else ["_floor"]))
    )


def first_groups(df: DataFrame, key: str, hot: DataFrame, order: Ordering) -> DataFrame:
    """For keys in hot buckets of ``df``: the salt group with the first row of the key."""
    if "row_id" in df.columns:
        # Other rows go before the joins that made ``df``; a place in the scan would not outlive that.
        buckets = [r[0] for r in hot.select("_bucket").limit(FEW_BUCKETS + 1).collect()]
        df = df.where(_bucket(key).isin(buckets)) if len(buckets) <= FEW_BUCKETS else df
    first = F.min(F.struct(*order.sort_key(), F.col("_salt")))
    return (
        with_salt(df, key, hot)
        .where("_hot")
        .groupBy("_key", "_key_null")
        .agg(first.alias("_first"))
        .select("_key", "_key_null", F.col("_first._salt").alias("_salt"), F.lit(True).alias("_leads"))
    )


def number_in_group(salted: DataFrame, order: Ordering, ties: list[str]) -> DataFrame:
    """Add ``_rn``: the row's number within its (key, salt) group."""
    groups = [c for c in ("_key", "_key_null", "_salt") if c in salted.columns]
    w = Window.partitionBy(*groups).orderBy(*order.window_order(), *[F.col(c).asc_nulls_last() for c in ties])
    return salted.withColumn("_rn", F.row_number().over(w))


def flagged(numbered: DataFrame, df: DataFrame, key: str, order: Ordering, name: str, hot: DataFrame | None) -> DataFrame:
    """The numbered rows of ``df`` with ``key`` again, and ``name``: TRUE unless a row is the first of its key."""
    if hot is None:
        return numbered.withColumn(name, F.col("_rn") > 1).withColumnRenamed("_key", key)
    rows = numbered.join(first_groups(df, key, hot, order), ["_key", "_key_null", "_salt"], "left")
    leads = ~F.col("_hot") | F.coalesce(F.col("_leads"), F.lit(False))
    again = rows.withColumn(name, ~((F.col("_rn") == 1) & leads))
    return again.withColumn(key, F.when(~F.col("_key_null"), F.col("_key")))


def flag_repeats(
    df: DataFrame,
    key: str,
    order: Ordering,
    name: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add boolean ``name``: TRUE for every row of ``key`` but its first."""
    hot = found(hot if hot is not None else hot_buckets(df, key))
    numbered = number_in_group(with_salt(df, key, hot), order, [])
    return flagged(numbered, df, key, order, name, hot).select(*df.columns, name)
