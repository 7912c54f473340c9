"""Seed known defects into an order table, to measure what the detectors find.

Which rows are hit is decided by a hash of (tag, row key), so seeding needs no
shuffle, gives the same rows on every run and retry, and hits rows independently
per category.  ``rate`` is the largest share of rows per category and batch; half of
it is hit on average.  :func:`seed_exact` draws an exact number of rows per batch
instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustline.functions.hashing import hash_number, selected, tagged_hash
from trustline.operators import duplicates as dup
from trustline.operators.mart import as_of_date, flagged_orders
from trustline.operators.ranking import row_number_within
from trustline.sources.tables import materialise, scratch_folder

# Fixed values.
STATUS_TYPOS = ["Completado", "completed", "Shipped!", "Pending...", "Cancelled (User)"]
INFLATION = 1.5
FUTURE_DAYS = 10_000
MAX_COPIES_PER_BATCH = 5
DEFAULT_RATE = 0.10
# Digits of the hash by which a batch is counted: 16 times as many slices for each.
SLICE_DIGITS = 2

# Categories in the order they are applied; later ones see the result of earlier ones.
CATEGORIES = ["ghost", "null", "neg", "math", "future", "typo"]

# Category -> flag that should find it.
DETECTED_BY = {
    "ghost": "is_orphan_order",
    "null": "is_orphan_order",
    "neg": "has_negative_amount",
    "math": "has_math_error",
    "future": "is_future_order",
    "typo": "has_bad_status",
    "copy": "is_duplicate",
}


def future_day(as_of: dt.date | str | None) -> Column:
    return F.date_add(as_of_date(as_of), FUTURE_DAYS)


def typo(keys: list[str]) -> Column:
    """One of the typo texts, by hash of the row key."""
    pick = hash_number("typo-pick", keys) % len(STATUS_TYPOS)
    return F.element_at(F.array(*[F.lit(t) for t in STATUS_TYPOS]), (pick + 1).cast("int"))


def apply_defect(
    df: DataFrame, tag: str, hit: Column, keys: list[str], as_of: dt.date | str | None = None
) -> DataFrame:
    """Apply one category to the rows where ``hit`` holds.  ``df`` has staging types."""
    changes = {
        "ghost": ("customer_id", F.concat(F.lit("ghost-"), F.col("customer_id"))),
        "null": ("customer_id", F.lit(None).cast("string")),
        "neg": ("total_amount", F.col("total_amount") * -1),
        "math": ("total_amount", F.col("total_amount") * INFLATION),
        "future": ("order_date", future_day(as_of)),
        "typo": ("status", typo(keys)),
    }
    column, value = changes[tag]
    return df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))


def seed_defects(
    df: DataFrame,
    key_cols: list[str],
    rate: float = DEFAULT_RATE,
    tags: list[str] | None = None,
    as_of: dt.date | str | None = None,
    markers: bool = False,
) -> DataFrame:
    """Seed the categories in ``tags`` (default: all six).

    ``key_cols`` must tell rows apart and must not be changed by a category.  With
    ``markers``, boolean columns ``seeded_<tag>`` record which rows were hit.
    """
    for tag in CATEGORIES if tags is None else tags:
        hit = selected(tag, key_cols, rate / 2)
        if markers:
            df = df.withColumn(f"seeded_{tag}", hit)
        df = apply_defect(df, tag, hit, key_cols, as_of)
    return df


def _draw(tag: str, rate: float) -> Column:
    """How many of the ``_rows`` of ``_batch`` to hit."""
    return hash_number(tag, ["_batch"]) % (F.floor(F.col("_rows") * rate) + 1)


def batch_draws(df: DataFrame, tag: str, batch: str, rate: float) -> DataFrame:
    """(_batch, _draw): how many rows of each batch to hit, 0 .. floor(rows x rate)."""
    return (
        df.groupBy(F.col(batch).alias("_batch"))
        .agg(F.count("*").alias("_rows"))
        .select("_batch", _draw(tag, rate).alias("_draw"))
    )


def draw_ends(df: DataFrame, tag: str, key_cols: list[str], batch: str, rate: float) -> DataFrame:
    """(_batch, _end, _left): where the draw of a batch ends; batches without hits are left out.

    The rows of a batch are counted in slices by the first digits of their hash.  Slices before ``_end`` are
    hit as a whole, and of that slice ``_left`` rows.
    """
    counts = df.groupBy(F.col(batch).alias("_batch"), _slice(tagged_hash(tag, key_cols)).alias("_end")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("_batch")
    before = F.sum("_n").over(whole.orderBy("_end").rowsBetween(Window.unboundedPreceding, -1))
    sums = counts.withColumns({"_rows": F.sum("_n").over(whole), "_before": F.coalesce(before, F.lit(0))})
    drawn = sums.withColumn("_left", _draw(tag, rate) - F.col("_before"))
    return drawn.where(F.col("_left").between(1, F.col("_n"))).select("_batch", "_end", "_left")


def _slice(hash: Column) -> Column:
    return F.substring(hash, 1, SLICE_DIGITS)


def pick_exact(
    df: DataFrame,
    tag: str,
    key_cols: list[str],
    batch: str,
    rate: float,
    ties: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``_hit``: exactly the drawn number of rows of each batch, by smallest hash.

    Where each draw ends is counted when this is called, and stored: one row for each batch.  Only the rows of the
    slice in which it ends are ranked, one in 256; those of hot batches (see ``ranking``) are stored for it.  All
    others are hit or not by their hash alone, so they are not shuffled.  A NULL batch is a batch, too.

    ``df`` is read two or three times: store it first where it is costly to make.
    """
    spark = df.sparkSession
    root = scratch_folder(spark, "draws")
    ends = materialise(draw_ends(df, tag, key_cols, batch, rate), f"{root}/ends")
    hashed = df.withColumn("_hash", tagged_hash(tag, key_cols))
    rows = hashed.join(ends, F.col(batch).eqNullSafe(F.col("_batch")), "left")
    ended = F.coalesce(_slice(F.col("_hash")) == F.col("_end"), F.lit(False))
    last, others = rows.where(ended), rows.where(~ended)
    order = dup.Ordering(("_hash", *ties))
    hot = dup.found(hot if hot is not None else dup.hot_buckets(last.select(batch), batch))
    if hot is None:
        window = Window.partitionBy(batch).orderBy(*order.window_order())
        ranked = last.withColumn("_rank", F.row_number().over(window))
    else:
        ranked = row_number_within(materialise(last, f"{root}/last"), batch, order, "_rank", hot)
    hit = others.withColumn("_hit", F.coalesce(_slice(F.col("_hash")) < F.col("_end"), F.lit(False)))
    return hit.select(*df.columns, "_hit").union(ranked.select(*df.columns, (F.col("_rank") <= F.col("_left")).alias("_hit")))


def seed_exact(
    df: DataFrame,
    tag: str,
    key_cols: list[str],
    batch: str,
    rate: float = DEFAULT_RATE,
    ties: list[str] | None = None,
    as_of: dt.date | str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Seed one category into an exact, varying number of rows of each batch."""
    hit = pick_exact(df, tag, key_cols, batch, rate, ties or [], hot)
    return apply_defect(hit, tag, F.col("_hit"), key_cols, as_of).drop("_hit")


def copies_to_add(df: DataFrame, key_cols: list[str], batch: str, ties: list[str] | None = None) -> DataFrame:
    """0 to 5 rows of each batch, by hash.

    The fixed limit makes Spark keep only five rows per batch and task before the
    shuffle, so a hot batch costs no more than a small one.
    """
    order = [tagged_hash("copy", key_cols), *[F.col(t).asc_nulls_last() for t in ties or []]]
    number = F.row_number().over(Window.partitionBy(batch).orderBy(*order))
    first = df.withColumn("_rn", number).where(F.col("_rn") <= MAX_COPIES_PER_BATCH)
    draw = hash_number("copies", [batch])
    return first.where(F.col("_rn") <= draw % (MAX_COPIES_PER_BATCH + 1)).drop("_rn")


def seed_duplicates(
    df: DataFrame, key_cols: list[str], batch: str, ties: list[str] | None = None, marker: bool = False
) -> DataFrame:
    """Append full copies of 0 to 5 rows per batch; run it after the other categories."""
    copies = copies_to_add(df, key_cols, batch, ties)
    if marker:
        df = df.withColumn("seeded_copy", F.lit(False))
        copies = copies.withColumn("seeded_copy", F.lit(True))
    return df.unionByName(copies)


def seed_all(
    df: DataFrame,
    key_cols: list[str],
    batch: str,
    rate: float = DEFAULT_RATE,
    as_of: dt.date | str | None = None,
    markers: bool = False,
) -> DataFrame:
    """The six categories, then the copies.  ``batch`` must not be changed by a category."""
    return seed_duplicates(
        seed_defects(df, key_cols, rate, as_of=as_of, markers=markers), key_cols, batch, marker=markers
    )


def detector_recall(
    seeded: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: dt.date | str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Per category: rows seeded, rows of those the flag found, and their ratio.

    ``seeded`` comes from ``seed_all(..., markers=True)``.  Its status is put in upper
    case as staging does, which repairs one of the typos.  A copy sorts after the row it
    was made from, so the copy is the one to be flagged.
    """
    seeded = seeded.withColumn("status", F.upper("status"))
    present = [t for t in DETECTED_BY if f"seeded_{t}" in seeded.columns]
    flagged = flagged_orders(seeded, customers, products, as_of, hot, ("quantity", "seeded_copy"))
    counts = []
    for tag in present:
        hit = F.col(f"seeded_{tag}")
        counts += [
            F.count_if(hit).alias(f"{tag}_seeded"),
            F.count_if(hit & F.col(DETECTED_BY[tag])).alias(f"{tag}_found"),
        ]
    rows = [
        F.struct(
            F.lit(tag).alias("defect"),
            F.lit(DETECTED_BY[tag]).alias("flag"),
            F.col(f"{tag}_seeded").alias("seeded"),
            F.col(f"{tag}_found").alias("detected"),
        )
        for tag in present
    ]
    recall = F.try_divide(F.col("detected"), F.col("seeded"))
    return flagged.agg(*counts).select(F.inline(F.array(*rows))).withColumn("recall", recall)
