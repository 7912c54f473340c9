"""Prefix trie of conversations as a z-fast trie in tables.

The compacted trie has a node wherever conversations branch or end; the edge above it covers
the depths (top, bottom] and is read off any conversation that passes.  An edge is found by two
keys: the prefix hash at its handle, the depth in (top, bottom] with the most trailing zero
bits, and at its entry, top + 1.  A conversation looks for its exit by fat binary search: the
handle of the remaining depths (lo, hi] is looked up; if it is there the search goes on below
that node, else above the handle.  When at most FAN depths remain, all their keys are looked up
at once, so a short conversation takes one join.  Within the edge the length of the common
prefix is found the same way, by comparing FAN depths at a time with the edge's conversation.

Conversations are inserted in batches: all that are waiting look for their exits; of those
that leave the trie at one place by one turn a leader, drawn by hash, is inserted, and the
others wait, as they may share more with it.  Edges are cut where leaders leave or
conversations end.  A leader takes a random way through what waits behind it, so the number of
batches grows with the logarithm of the conversations.

Sums over subtrees come from pointer doubling along the compacted trie; then edges are expanded
to one node for each depth.

A prefix's hash is the exclusive or of its turns' hashes with their depths in them, 128 bits.
Turns are numbered by ranges of the whole order with carried counts, prefix sums run over
chunks, equal conversations are collapsed before anything else, and counts by hash are combined
before the shuffle; so neither a conversation with a third of all turns nor a turn with which a
third of all conversations begin meets in one task.

Defined cases: turns are ordered by number, NULL first, then role and text; a NULL role or text
is empty; turns without a conversation id are left out; repeated rows are separate turns.  A
table without conversations gives no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustline.llm.shared import lean, partitions, stored

CHUNK = 1024  # turns whose prefix sums run in one window
FAN = 16  # depths looked up at once
FAMILY = 5  # conversations that share a beginning
SHARED = 9  # hash values of shared lengths, 0 to 8
EMPTY = hashlib.sha256(b"").hexdigest()


def _numbered() -> object:
    """Rows sorted by conversation. Adds part and nth, the place within the task's rows of the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            begins = np.append(True, conv[1:] != conv[:-1])
            first = np.flatnonzero(begins)
            nth = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
            if conv[0] == last:
                nth[: first[1] if len(first) > 1 else len(conv)] += n
            last, n = conv[-1], int(nth[-1])
            columns = [*batch.columns, pa.array(np.full(len(conv), part), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "nth"])

    return run


def positions(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Stored: conv, position (from 1), a and b (content hashes) and bytes of each turn."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "tie"]
    sorted_ = rows.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    hashed = sorted_.select(
        "conv", F.xxhash64(F.lit("a"), "role", "text").alias("a"), F.xxhash64(F.lit("b"), "text", "role").alias("b"), F.octet_length("text").cast("long").alias("bytes")
    )
    local = stored(hashed.mapInArrow(lean(_numbered()), "conv long, a long, b long, bytes long, part int, nth long"), "turns")

    # A conversation goes on from partition to partition: it is the last one there and the first one here.
    edges = local.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "nth")).alias("last")).orderBy("part").collect()  # a row for each partition
    carried, at, conv = [], 0, None
    for e in edges:
        if e.first == conv:
            carried.append((e.part, e.first, at))
        at = at + e.last.nth if e.first == e.last.conv == conv else e.last.nth
        conv = e.last.conv
    carry = turns.sparkSession.createDataFrame(carried, "part int, conv long, before long")
    return local.join(F.broadcast(carry), ["part", "conv"], "left").select(
        "conv", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("position"), "a", "b", "bytes"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv and n, conv, position, a, b and bytes of each turn) of conversations that begin with turns of their family's first."""
    counts = stored(turns.groupBy("conv").agg(F.count("*").alias("n")), "conversations")
    known = counts.select("conv", "n", F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(SHARED)).alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    given = F.least("h", F.coalesce("n_base", F.lit(0))).alias("given")
    info = known.join(counts.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left").select("conv", "base", "h", "n", given)
    heads = turns.where((F.col("position") < SHARED) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "base")
    ahead = info.join(heads, "base").where("position <= h").select("conv", "position", "a", "b", "bytes")
    own = turns.join(info.select("conv", "h", "given"), "conv").where("position > h")
    own = own.select("conv", (F.col("position") - F.col("h") + F.col("given")).alias("position"), "a", "b", "bytes")
    return info.select("conv", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), ahead.unionByName(own)


def prefixes(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv, position, the hash x, y and the bytes (``upto``) of the conversation up to it, and the turn's own bytes."""
    rows = turns.withColumns(
        {"chunk": F.floor((F.col("position") - 1) / chunk), "hx": F.xxhash64("position", "a", "b"), "hy": F.xxhash64("b", "position", "a")}
    )
    so_far = Window.partitionBy("conv", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "chunk").agg(F.bit_xor("hx").alias("sx"), F.bit_xor("hy").alias("sy"), F.sum("bytes").alias("sb"))
    sums = sums.select("conv", "chunk", F.bit_xor("sx").over(earlier).alias("px"), F.bit_xor("sy").over(earlier).alias("py"), F.sum("sb").over(earlier).alias("pb")).where("chunk > 0")
    rolled = rows.withColumns({"rx": F.bit_xor("hx").over(so_far), "ry": F.bit_xor("hy").over(so_far), "rb": F.sum("bytes").over(so_far)})
    none = F.lit(0).cast("long")
    return rolled.join(sums, ["conv", "chunk"], "left").select(
        "conv",
        "position",
        F.coalesce("px", none).bitwiseXOR(F.col("rx")).alias("x"),
        F.coalesce("py", none).bitwiseXOR(F.col("ry")).alias("y"),
        (F.coalesce("pb", none) + F.col("rb")).alias("upto"),
        "bytes",
    )


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zero bits."""
    return F.expr(f"{high} & shiftleft(-1L, length(bin({low} ^ {high})) - 1)")


def dressed(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Edges (path, top, bottom) with handle depth and the hashes at top, entry, handle and bottom."""
    asked = edges.select("path", "top", "bottom").withColumn("handle", two_fattest("top", "bottom"))
    asked = asked.withColumn("position", F.explode(F.array_distinct(F.array(F.col("top"), F.col("top") + 1, F.col("handle"), F.col("bottom")))))
    found = asked.join(paths.withColumnRenamed("conv", "path"), ["path", "position"])
    place = {"p": F.col("top"), "c": F.col("top") + 1, "h": F.col("handle"), "e": F.col("bottom")}
    at = [F.max(F.when(F.col("position") == d, F.struct("x", "y", "upto"))).alias(name) for name, d in place.items()]
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("x", "y", "upto")])
    return found.groupBy("path", "top", "bottom", "handle").agg(*at).withColumn("p", F.coalesce("p", none))


def _keys(edges: DataFrame) -> DataFrame:
    """at, x, y and the edge they belong to: its handle, and its entry where that is another depth."""
    handle = edges.select(F.col("handle").alias("at"), "h.x", "h.y", "path", "bottom")
    entry = edges.where("handle > top + 1").select((F.col("top") + 1).alias("at"), "c.x", "c.y", "path", "bottom")
    return handle.unionByName(entry)


def _fat_search(waiting: DataFrame, paths: DataFrame, edges: DataFrame, longest: int, fan: int) -> DataFrame:
    """seq, n, and the deepest edge of which a key is a prefix, with that key's depth (``known``); no path where there is none."""
    none = F.lit(None).cast("long")
    state = waiting.select("seq", "n", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"), none.alias("path"), none.alias("bottom"), F.lit(0).cast("long").alias("known"))
    handles = edges.select(F.col("handle").alias("at"), "h.x", "h.y", F.col("path").alias("fp"), F.col("bottom").alias("fb"))
    for _ in range(max(0, math.ceil(math.log2(max(1, longest) / fan)))):
        probe = state.withColumn("at", F.when(F.col("hi") - F.col("lo") > fan, two_fattest("lo", "hi")).otherwise(F.lit(-1)))
        probe = probe.join(paths.select(F.col("conv").alias("seq"), F.col("position").alias("at"), "x", "y"), ["seq", "at"], "left")
        # Those that don't ask are spread by their own number.
        probe = probe.withColumns({"x": F.coalesce("x", "seq"), "y": F.coalesce("y", F.lit(0))}).join(handles, ["at", "x", "y"], "left")
        hit = F.col("fp").isNotNull()
        state = probe.select(
            "seq",
            "n",
            F.when(hit, F.col("fb")).otherwise(F.col("lo")).alias("lo"),
            F.when((F.col("at") > 0) & ~hit, F.col("at") - 1).otherwise(F.col("hi")).alias("hi"),
            F.coalesce("fp", "path").alias("path"),
            F.coalesce("fb", "bottom").alias("bottom"),
            F.when(hit, F.col("at")).otherwise(F.col("known")).alias("known"),
        )
    if longest > fan:
        state = stored(state, "searched")
    # What is left: every depth up to the entry below the last one that a node can end at.
    left = state.select(F.col("seq").alias("conv"), "lo", "hi").join(paths, "conv").where("position > lo AND position <= hi + 1")
    deepest = left.select("conv", F.col("position").alias("at"), "x", "y").join(_keys(edges), ["at", "x", "y"])
    deepest = deepest.groupBy(F.col("conv").alias("seq")).agg(F.max(F.struct("at", "path", "bottom")).alias("key"))
    return state.join(deepest, "seq", "left").select(
        "seq", "n", F.coalesce("key.path", "path").alias("path"), F.coalesce("key.bottom", "bottom").alias("bottom"), F.coalesce("key.at", "known").alias("known")
    )


def _common(found: DataFrame, paths: DataFrame, longest: int, fan: int) -> DataFrame:
    """``found`` with depth, to which each sequence goes along its edge's path; 0 without an edge."""
    state = found.withColumns({"lo": F.col("known"), "hi": F.coalesce(F.least("n", "bottom"), F.lit(0))})
    mine = paths.select(F.col("conv").alias("seq"), F.col("position").alias("at"), "x", "y")
    theirs = paths.select(F.col("conv").alias("path"), F.col("position").alias("at"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    for last in reversed(range(max(1, math.ceil(math.log(max(2, longest), fan))))):
        step = F.ceil((F.col("hi") - F.col("lo")) / fan)
        depths = F.when(F.col("hi") > F.col("lo"), F.array_distinct(F.concat(F.sequence(F.col("lo") + step, F.col("hi"), step), F.array("hi"))))
        asked = state.where("hi > lo").select("seq", "path", F.explode(depths).alias("at"))
        same = asked.join(mine, ["seq", "at"]).join(theirs, ["path", "at"]).withColumn("same", (F.col("x") == F.col("tx")) & (F.col("y") == F.col("ty")))
        told = same.groupBy("seq").agg(F.max(F.when(F.col("same"), F.col("at"))).alias("to"), F.min(F.when(~F.col("same"), F.col("at"))).alias("off"))
        state = state.join(told, "seq", "left").withColumns({"lo": F.coalesce("to", "lo"), "hi": F.coalesce(F.col("off") - 1, "hi")}).drop("to", "off")
        state = stored(state, "common") if last else state
    return state.select("seq", "n", "path", "bottom", F.col("lo").alias("depth"))


def cut(edges: DataFrame, cuts: DataFrame) -> DataFrame:
    """path, top and bottom of the parts of those ``edges`` that are cut at the depths in ``cuts`` (path, bottom, at)."""
    own = edges.select("path", "bottom", "top").join(cuts.select("path", "bottom").distinct(), ["path", "bottom"])
    ends = cuts.select("path", "bottom", "at", F.lit(None).cast("long").alias("top")).unionByName(own.select("path", "bottom", F.col("bottom").alias("at"), "top"))
    along = Window.partitionBy("path", "bottom").orderBy("at")
    whole = Window.partitionBy("path", "bottom")
    parts = ends.select("path", F.coalesce(F.lag("at").over(along), F.max("top").over(whole)).alias("top"), F.col("at").alias("bottom"))
    return parts


def build(sequences: DataFrame, paths: DataFrame, fan: int = FAN) -> DataFrame | None:
    """Edges of the compacted trie of ``sequences`` (seq, n), whose prefixes are in ``paths``; None without any."""
    waiting = sequences.where("n > 0").select("seq", "n")
    longest = waiting.agg(F.max("n")).first()[0]
    edges = None
    while longest:
        if edges is None:
            none = F.lit(None).cast("long")
            found = waiting.select("seq", "n", none.alias("path"), none.alias("bottom"), F.lit(0).cast("long").alias("depth"))
        else:
            found = _common(stored(_fat_search(waiting, paths, edges, longest, fan), "found"), paths, longest, fan)
        following = paths.select(F.col("conv").alias("seq"), (F.col("position") - 1).alias("depth"), "x", "y")
        exits = stored(found.join(following, ["seq", "depth"], "left"), "exits")
        leaving = exits.where("depth < n")
        first = F.min(F.struct(F.xxhash64("seq").alias("draw"), "seq", "n", "path", "bottom")).alias("first")
        leaders = stored(leaving.groupBy("depth", "x", "y").agg(first).select("depth", "first.*"), "leaders")
        placed = leaders.unionByName(exits.where("depth = n"), allowMissingColumns=True)
        cuts = placed.where("depth < bottom AND depth > 0").select("path", "bottom", F.col("depth").alias("at")).distinct()
        new = leaders.select(F.col("seq").alias("path"), F.col("depth").alias("top"), F.col("n").alias("bottom"))
        if edges is None:
            edges = stored(dressed(new, paths), "edges")
        else:
            cuts = stored(cuts, "cuts")
            kept = edges.join(cuts.select("path", "bottom").distinct(), ["path", "bottom"], "left_anti")
            edges = stored(kept.select(*edges.columns).unionByName(dressed(cut(edges, cuts).unionByName(new), paths)), "edges")
        waiting = stored(leaving.join(leaders.select("seq"), "seq", "left_anti").select("seq", "n"), "waiting")
        longest = waiting.agg(F.max("n")).first()[0]
    return edges


def _above() -> Column:
    """The node to look up for ``up``; where there is none, one that doesn't exist, another for each row."""
    return F.coalesce("up", F.struct(F.col("node.path").alias("path"), F.lit(-1).cast("long").alias("bottom")))


def subtrees(nodes: DataFrame) -> DataFrame:
    """Sums over subtrees by pointer doubling.

    ``nodes`` has node, up (its parent, NULL below the root) and values: members, least, leaves, weight, length.
    """
    state = stored(nodes, "subtree")
    while state.where("up IS NOT NULL").limit(1).count():
        gained = state.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
            F.sum("members").alias("gm"), F.min("least").alias("gl"), F.sum("leaves").alias("gv"), F.sum("weight").alias("gw"), F.sum("length").alias("gn")
        )
        above = state.where("up IS NOT NULL").select(F.col("node").alias("above"), F.col("up").alias("next"))
        none = F.lit(0).cast("long")
        state = stored(
            state.join(gained, "node", "left")
            .withColumn("above", _above())
            .join(above, "above", "left")
            .select(
                "node",
                F.col("next").alias("up"),
                (F.col("members") + F.coalesce("gm", none)).alias("members"),
                F.least("least", F.coalesce("gl", "least"), F.coalesce("least", "gl")).alias("least"),
                (F.col("leaves") + F.coalesce("gv", none)).alias("leaves"),
                (F.col("weight") + F.coalesce("gw", none)).alias("weight"),
                (F.col("length") + F.coalesce("gn", none)).alias("length"),
            ),
            "subtree",
        )
    return state.drop("up")


def _digests() -> object:
    """Columns in, sorted: n, x, y, conv. Out: n, x, y and the digest of the ids, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["n", "x", "y", "ends"])

        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if len(out) > 10_000:
                yield batch_of()
                out = []
        if key is not None:
            out.append((*key, digest.hexdigest()))
        if out:
            yield batch_of()

    return run


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(turns: DataFrame, chunk: int = CHUNK, fan: int = FAN, **columns) -> DataFrame:
    """Every node of the trie of rebuilt conversations, one row for each depth."""
    counts, own = rebuilt(positions(turns, **columns))
    rolled = stored(prefixes(own, chunk), "prefixes")
    zero = F.lit(0).cast("long")
    whole = rolled.select("conv", F.col("position").alias("n"), "x", "y")
    members = stored(counts.join(whole, ["conv", "n"], "left").select("conv", "n", F.coalesce("x", zero).alias("x"), F.coalesce("y", zero).alias("y")), "members")
    ids = F.xxhash64("n", "x", "y")
    digests = members.select("n", "x", "y", "conv").repartition(partitions(turns.sparkSession), ids).sortWithinPartitions("n", "x", "y", "conv")
    ends = members.groupBy("n", "x", "y").agg(F.min("conv").alias("seq"), F.count("*").alias("copies"))
    ends = stored(ends.join(digests.mapInArrow(lean(_digests()), "n long, x long, y long, ends string"), ["n", "x", "y"]), "ends")
    paths = rolled.join(ends.select(F.col("seq").alias("conv")), "conv", "left_semi")
    paths = stored(paths, "paths")
    edges = build(ends, paths, fan)

    spark = turns.sparkSession
    total = ends.agg(F.min("seq").alias("least"), F.sum("copies").alias("members"), F.max(F.when(F.col("n") == 0, F.col("ends"))).alias("ends")).first()
    if not total.members:
        return spark.createDataFrame([], RESULT)
    if edges is None:
        return spark.createDataFrame([(total.least, 0, None, total.members, 0, 1, 0, total.ends or EMPTY)], RESULT)

    # Nodes with what ends there; the first conversation that passes and the depth name a node.
    at_end = ends.select(F.col("n").alias("bottom"), F.col("x").alias("ex"), F.col("y").alias("ey"), "seq", "copies", "ends")
    under_root = F.col("top") == 0  # no parent is looked up there, so the key is spread by the path
    flat = edges.select(
        F.struct("path", "bottom").alias("node"), "path", "top", "bottom", F.when(under_root, F.col("path")).otherwise(F.col("p.x")).alias("px"), F.col("p.y").alias("py"), F.col("p.upto").alias("before"),
        F.col("e.x").alias("ex"), F.col("e.y").alias("ey"), F.col("e.upto").alias("upto"),
    )
    parent = flat.select(F.col("node").alias("up"), F.col("bottom").alias("top"), F.col("ex").alias("px"), F.col("ey").alias("py"))
    nodes = stored(flat.join(parent, ["top", "px", "py"], "left").join(at_end, ["bottom", "ex", "ey"], "left"), "nodes")
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("children"))
    nodes = stored(nodes.join(children, "node", "left").withColumn("children", F.coalesce("children", zero)), "nodes")
    copies = F.coalesce("copies", zero)
    sums = subtrees(
        nodes.select(
            "node", "up", copies.alias("members"), F.col("seq").alias("least"), (F.col("children") == 0).cast("long").alias("leaves"),
            (copies * F.col("upto")).alias("weight"), (F.col("upto") - F.col("before")).alias("length"),
        )
    )
    # Sum of (members - 1) * bytes over a subtree: each conversation's bytes below the top, less the bytes of the edges.
    saved = F.col("weight") - F.col("members") * F.col("before") - F.col("length")
    known = stored(nodes.drop("seq", "copies").join(sums, "node").withColumn("saved", saved), "known")
    least_above = known.select(F.col("node").alias("above"), F.col("least").alias("least_above"))
    known = known.withColumn("above", _above()).join(least_above, "above", "left")

    block = F.lit(4096)
    depths = F.sequence(F.col("first"), F.least(F.col("first") + block - 1, F.col("bottom")))
    expanded = known.withColumn("first", F.explode(F.sequence(F.col("top") + 1, F.col("bottom"), block))).withColumn("depth", F.explode(depths))
    expanded = expanded.join(paths.select(F.col("conv").alias("path"), F.col("position").alias("depth"), F.col("upto").alias("here"), "bytes"), ["path", "depth"])
    last = F.col("depth") == F.col("bottom")
    inner = expanded.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("top") + 1, F.col("least")).otherwise(F.coalesce("least_above", F.lit(total.least))).alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("members") - 1) * (F.col("here") - F.col("bytes") - F.col("before"))).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends")), F.lit(EMPTY)).alias("ends_sha256"),
    )
    upper = known.where("top = 0").agg(F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    root = spark.createDataFrame([(total.least, 0, None, total.members, upper.children, upper.leaves, upper.saved, total.ends or EMPTY)], RESULT)
    return root.unionByName(inner)
