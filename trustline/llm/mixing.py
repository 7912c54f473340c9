"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a sequence of slots of BLOCK words.  Slot i looks at the golden-ratio point
frac((i + 1) * phi); the source whose span of cumulated target shares holds the point gets
the slot, so any stretch of the mix has the sources in nearly their shares.  Within a source
slots are ranked, and the r-th takes the r-th block of the source's documents, shuffled and
laid end to end; past the end a new epoch repeats them.  Ranks and offsets are sums over
buckets of bounded size, so no source's rows meet in one task.

A target is its share of all words by weight, at most MAX_EPOCHS times the source's words;
what is above goes to the others by weight until none is above.  Every source gives its
target to the word.

Defined cases: a NULL or empty text has no words and is never taken; NULL is a source of its
own, the last one; repeated rows are separate documents that are taken separately.  Without
any words nothing is taken.  Other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustline.llm.shared import place, stored

BLOCK = 1024  # words of a slot
WEIGHTS = (1, 2, 3)  # repeating, by the sources' order
MAX_EPOCHS = 3
MAX_SOURCES = 100_000  # more are refused: their totals pass through the driver
BUCKET_ROWS = 1_000
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949


def targets(sizes: dict[str | None, int], weights: dict[str | None, int], most: int = MAX_EPOCHS) -> dict[str | None, float]:
    """Words that each source should give: its weight's share of all words, capped, the excess reshared by weight."""
    total = sum(sizes.values())
    out: dict[str | None, float] = {}
    left, open_sources = float(total), set(sizes)
    while open_sources:
        weight = sum(weights[s] for s in open_sources)
        above = {s for s in open_sources if left * weights[s] / weight > most * sizes[s]}
        if not above:
            out.update({s: left * weights[s] / weight for s in open_sources})
            break
        out.update({s: float(most * sizes[s]) for s in above})
        left = total - sum(out.values())
        open_sources -= above
    return out


def ordered_sources(sizes: dict[str | None, int]) -> list[str | None]:
    """By code point, NULL last."""
    return sorted(sizes, key=lambda s: (s is None, s or ""))


def default_weights(sizes: dict[str | None, int]) -> dict[str | None, int]:
    return {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(ordered_sources(sizes))}


def _running(df: DataFrame, key: str, value: str, out: str, tie: list[str]) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the same ``key`` that come before in (bucket, tie) order."""
    inner = Window.partitionBy(key, "bucket").orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(key, "bucket").agg(F.sum(value).alias("s")).withColumn("before", F.coalesce(F.sum("s").over(outer), F.lit(0))).drop("s")
    within = df.withColumn("own", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return within.join(sums, [key, "bucket"]).withColumn(out, F.col("before") + F.col("own")).drop("before", "own")


def schedule(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: row (a number for each), id, source, size, source_size, target, key.
    pieces: row, slot, epoch, first word and words of the document that the slot takes.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    ident = F.col(f"`{id_col}`").cast("long")
    sized = stored(
        docs.select(ident.alias("id"), F.xxhash64(text).alias("text_hash"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "sizes",
    )
    rows = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r.source: r.words for r in rows}
    weights, order = default_weights(sizes), ordered_sources(sizes)
    target = targets(sizes, weights)
    total = sum(sizes.values())
    at, table = 0.0, []
    for i, s in enumerate(order):
        at += target[s] / total if total else 0.0
        table.append((i, s, sizes[s], target[s], at))
    known = F.broadcast(spark.createDataFrame(table, "code int, source string, source_size long, target double, high double"))
    sources = known.withColumnRenamed("source", "s")
    documents = sized.join(sources, sized["source"].eqNullSafe(F.col("s")), "left").drop("s", "high")

    # Documents in shuffled order, end to end within their source.
    n_docs = sum(r.docs for r in rows)
    buckets = max(1, n_docs // BUCKET_ROWS)
    draw = F.xxhash64(F.lit(seed), "id", "text_hash")
    full = documents.where("size > 0").select("row", "code", "size", draw.alias("draw"), F.pmod(draw, F.lit(buckets)).alias("bucket"))
    laid = _running(full, "code", "size", "offset", ["draw", "row"])
    end = F.col("offset") + F.col("size")
    blocks = laid.select(
        "row", "code", "offset", "size", F.explode(F.sequence(F.floor(F.col("offset") / block), F.floor((end - 1) / block))).alias("block")
    )
    low, high = F.greatest("offset", F.col("block") * block), F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block)
    blocks = blocks.select("row", "code", "block", "offset", low.alias("low"), high.alias("high"))

    # Slots in golden-ratio order, ranked within their source by two sums.
    n_slots = -(-total // block)
    point = (F.col("id") + 1) * F.lit(GOLDEN)
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("point"), F.floor(F.col("id") / BUCKET_ROWS).alias("bucket"))
    code = F.least(place(F.col("point"), [t[-1] for t in table], "double"), F.lit(len(table) - 1))
    slots = slots.select("slot", code.cast("int").alias("code"), "bucket", F.lit(1).alias("one"))
    ranked = _running(slots, "code", "one", "rank", ["slot"]).select("slot", "code", "rank")
    # A source gives its target to the word: slots past it stay empty, a few that the points left out close the mix.
    quota = F.floor(F.col("goal") / F.col("source_size")) * F.col("per_epoch") + F.ceil(F.pmod("goal", "source_size") / block)
    quotas = known.where("source_size > 0").select("code", "source_size", F.round("target").cast("long").alias("goal"), F.ceil(F.col("source_size") / block).alias("per_epoch"))
    quotas = F.broadcast(quotas.withColumn("quota", quota))
    closing = quotas.join(ranked.groupBy("code").agg(F.count("*").alias("have")), "code", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    closing = closing.where("have < quota").select("code", "have", F.explode(F.sequence("have", F.col("quota") - 1)).alias("rank"))
    closing = closing.select((n_slots + F.col("code") + len(order) * (F.col("rank") - F.col("have"))).alias("slot"), "code", "rank")
    ranked = ranked.unionByName(closing).join(quotas, "code").where("rank < quota")
    ranked = ranked.select("slot", "code", F.floor(F.col("rank") / F.col("per_epoch")).alias("epoch"), F.pmod("rank", "per_epoch").alias("block"), "source_size", "goal")
    until = F.least("high", F.col("goal") - F.col("epoch") * F.col("source_size"))
    pieces = ranked.join(blocks, ["code", "block"]).withColumn("until", until).where("low < until")
    return documents, pieces.select("row", "slot", "epoch", (F.col("low") - F.col("offset")).alias("first"), (F.col("until") - F.col("low")).alias("words"))


def taken(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """Per document: what it is, its source's target, and the words that the mix takes of it."""
    sums = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return documents.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def copies(taken_words: Column, size: Column) -> Column:
    """How often a document goes into a mix of whole documents: its taken words by its size, rounded half up."""
    return F.when(size > 0, F.floor((2 * taken_words + size) / (2 * size))).otherwise(0)


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", **options) -> DataFrame:
    """The mix as whole documents with all their columns, each as often as its words are taken; only a source's last may round."""
    documents, pieces = schedule(docs, text_col, source_col, id_col, **options)
    ident, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    same = ["key", "text_hash", "no_id", "group"]
    group = F.xxhash64("key", "text_hash", "no_id", "source").alias("group")
    often = taken(documents, pieces).select(F.coalesce("id", "text_hash").alias("key"), "text_hash", F.col("id").isNull().alias("no_id"), "source", copies(F.col("taken"), F.col("size")).alias("often"))
    # Rows alike in id, text and source are alike in the mix: their sum is dealt to them, the first get what doesn't divide.
    often = often.select("often", "key", "text_hash", "no_id", group).groupBy(*same).agg(F.sum("often").alias("sum"), F.count("*").alias("n")).where("sum > 0")
    often = stored(often.select(*same, F.floor(F.col("sum") / F.col("n")).cast("int").alias("often"), (F.col("sum") % F.col("n")).alias("more")), "often")
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(docs.columns)],
        F.coalesce(ident, F.xxhash64(text)).alias("key"),
        F.xxhash64(text).alias("text_hash"),
        ident.isNull().alias("no_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
    )
    rows = keyed.withColumn("group", group)
    values = [f"k{i}" for i in range(len(docs.columns))]
    even = rows.join(often.where("more = 0"), same).select(*values, "often")
    # Few have a rest, as alike rows are neighbours in their source: those at its end.
    uneven = stored(rows.join(often.where("more > 0"), same).select("group", *values, "often", "more", F.monotonically_increasing_id().alias("nr")), "uneven")
    uneven = uneven.withColumn("one", F.lit(1)).withColumn("bucket", F.floor(F.col("nr") / BUCKET_ROWS))
    ranks = _running(uneven.select("group", "nr", "bucket", "one"), "group", "one", "rank", ["nr"]).select("nr", "rank")
    uneven = uneven.join(ranks, "nr").select(*values, (F.col("often") + (F.col("rank") < F.col("more")).cast("int")).alias("often")).where("often > 0")
    mixed = even.unionByName(uneven).withColumn("copy", F.explode(F.sequence(F.lit(1), "often")))
    return mixed.select(*values).toDF(*docs.columns)
