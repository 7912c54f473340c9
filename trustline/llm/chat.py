"""Chat formatting after cumulative snapshots are collapsed.

A chat service logs a conversation again as it grows, so most logs are the beginning of a
longer one.  Every prefix of a conversation gets a rolling hash, the exclusive or of its
turns' hashes with their positions in them (128 bits).  A conversation whose whole hash is a
longer one's prefix hash is a snapshot; an anti-join leaves those that nothing continues, one
of each set of equals, and these are rendered.

DataFrame functions only.  A conversation with very many turns (a third of all, or all those
without an id) is numbered by ranges of the whole order.  Hashes run over chunks of CHUNK
places and are carried from chunk to chunk as sums, so it is spread over many tasks; it is
rendered in parts of CHUNK turns.

Defined cases: turns come by number, NULL last, those with equal numbers by role and hash, and
repeated rows stay separate turns.  NULL roles and texts are rendered as empty, but differ from
empty ones when conversations are compared.  Turns without a conversation id are one
conversation, whose id is NULL and never stands for equals that have one.  Markers inside
texts are broken up by a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustline.llm.shared import stored
from trustline.operators.duplicates import HOT_ROWS, Ordering, hot_buckets
from trustline.operators.ranking import row_number_within

CHUNK = 1024
BEGIN, END = "<|im_start|>", "<|im_end|>"
_NO_TURN = (1 << 63) - 1


def _content_hash(seed: str) -> Column:
    parts = [F.lit(seed)]
    for c in ("role", "text"):
        parts += [F.col(c).isNull(), F.coalesce(c, F.lit(""))]
    return F.xxhash64(*parts)


def prefix_hashes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per turn: no_id, conv, position (from 1), role, text, and the hash x, y of the conversation up to it."""
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"),
        F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(_NO_TURN)).alias("turn"),
        F.col(f"`{role_col}`").alias("role"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = rows.withColumns({"has_role": F.col("role").isNotNull(), "a": _content_hash("a"), "b": _content_hash("b")})
    # Places in the whole order, so that chunks are even whatever the turn numbers are.
    placed = row_number_within(rows, "conv", Ordering(("turn", "has_role", "role", "a", "b")), "position", hot_buckets(rows, "conv", hot_rows))
    no_id, conv = F.col("conv").isNull().alias("no_id"), F.coalesce("conv", F.lit(0).cast("long")).alias("conv")
    hashes = [F.xxhash64("position", "a", "b").alias("x"), F.xxhash64("b", "position", "a").alias("y")]
    placed = stored(placed.select(no_id, conv, "position", F.floor((F.col("position") - 1) / chunk).alias("chunk"), "role", "text", *hashes), "turns")
    key = ["no_id", "conv"]
    so_far = Window.partitionBy(*key, "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    # Hashes within a chunk, after those of the chunks before it.
    sums = placed.groupBy(*key, "chunk").agg(F.bit_xor("x").alias("cx"), F.bit_xor("y").alias("cy"))
    none = F.lit(0).cast("long")
    sums = sums.select(*key, "chunk", F.coalesce(F.bit_xor("cx").over(earlier), none).alias("px"), F.coalesce(F.bit_xor("cy").over(earlier), none).alias("py"))
    rolled = placed.withColumns({"rx": F.bit_xor("x").over(so_far), "ry": F.bit_xor("y").over(so_far)}).join(sums, [*key, "chunk"])
    return rolled.select(*key, "position", "role", "text", F.col("px").bitwiseXOR(F.col("rx")).alias("x"), F.col("py").bitwiseXOR(F.col("ry")).alias("y"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """no_id, conv, n_turns and copies of the conversations that no longer one begins with; one of each set of equals."""
    key = ["no_id", "conv"]
    passing = prefixes.groupBy("position", "x", "y").agg(F.count("*").alias("passing"))
    last = prefixes.groupBy(*key).agg(F.max(F.struct("position", "x", "y")).alias("last")).select(*key, "last.*")
    ending = last.groupBy("position", "x", "y").agg(F.count("*").alias("copies"), F.min(F.struct("no_id", "conv")).alias("first"))
    # More conversations have this prefix than end with it.
    continued = passing.join(ending, ["position", "x", "y"]).where("passing > copies").select("position", "x", "y")
    return ending.join(continued, ["position", "x", "y"], "left_anti").select("first.*", F.col("position").alias("n_turns"), "copies")


def rendered(role: Column, text: Column) -> Column:
    def safe(c: Column) -> Column:
        return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<| "))

    return F.concat(F.lit(BEGIN), safe(role), F.lit("\n"), safe(text), F.lit(END + "\n"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", chunk: int = CHUNK, **columns) -> DataFrame:
    """conv_id, part, n_turns and copies of each maximal conversation, with its rendered text, in parts of ``chunk`` turns."""
    prefixes = stored(prefix_hashes(turns, conv_col, chunk=chunk, **columns), "prefixes")
    kept = prefixes.join(maximal(prefixes.drop("role", "text")), ["no_id", "conv"])
    lines = kept.select("no_id", "conv", "n_turns", "copies", "position", F.floor((F.col("position") - 1) / chunk).cast("int").alias("part"), rendered(F.col("role"), F.col("text")).alias("line"))
    parts = lines.groupBy("no_id", "conv", "part").agg(
        F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("position", "line"))).alias("lines")
    )
    return parts.select(F.when(~F.col("no_id"), F.col("conv")).alias("conv_id"), "part", "n_turns", "copies", F.array_join("lines.line", "").alias("text"))
