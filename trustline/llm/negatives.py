"""Hard negatives by a multiway hyperplane tree over vectors.

Vectors are scaled to whole numbers, so scores (inner products) are exact.  With one more
coordinate, sqrt(M^2 - |x|^2) for rows and 0 for anchors, where M is the largest norm, the
distance of an anchor from a row is sqrt(|a|^2 + M^2 - 2 score): a window of scores is an
annulus around the anchor.

The tree is fitted on a sample of about SAMPLE rows.  A node has up to FANOUT split points,
chosen far apart; a row belongs to the nearest, which halves space by hyperplanes.  All rows
are sent down the tree, and for each split point i and sibling subtree j the least and the
greatest distance from i to rows of j are kept.  A row x in an anchor's annulus [near, far]
has, with d the anchor's distance from i, a distance from i between max(d - far, near - d)
and d + far; where that range and the kept one don't meet, subtree j is eliminated.

Anchors first meet the sample, which bounds their windows: the k-th best row that a window
has there is at most as good as the k-th best of all.  Then they go to the leaves that remain
and are compared with each row in them.  Nothing is approximate; the sample and the tree
decide the cost alone.

Neighbouring leaves with few rows are read together, as one shelf of up to BLOCK rows.  A leaf
may also hold a third of all rows, and be asked by all anchors: a shelf's rows are dealt to
blocks of about BLOCK and its anchors to slots of as many, and each pair of block and slot is
one group.  The best of a group go on, and the best of these are found by rank, cut on both
sides of the shuffle.  Where vectors have no structure the ranges eliminate little, and the
cost is that of comparing every anchor with every row.

Defined cases: rows with a NULL label, a NULL vector, or a NULL or non-finite component take no
part.  A NULL id is larger than any other and is no anchor's.  Rows equal in all columns are
separate rows; an anchor's own row is no positive of it.  A shorter vector counts as padded by
zeros.  An anchor without positives, or a positive without negatives in its window, has no row.
Scores that may reach 2^55 raise an OverflowError.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustline.llm.shared import lean, stored

SAMPLE = 8192
FANOUT = 8
LEAF = 48  # sampled rows below which a node isn't split
BLOCK = 2048
_ALL, _NONE = np.iinfo(np.int64).max, np.iinfo(np.int64).min


@dataclass(frozen=True)
class Scale:
    """What the vectors of a table have in common."""

    rows: int
    dims: int
    norm: float  # M
    kind: str  # of the stored whole numbers
    exact: bool  # whether float64 holds every score

    @property
    def slack(self) -> float:
        """More than distances can be off by rounding."""
        return 2e-7 * (self.dims + 8) ** 0.5 * (self.norm + 1)


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return label.isNotNull() & vector.isNotNull() & finite


def scale_of(vectors: DataFrame, factor: int) -> Scale:
    """The common scale, by one pass of aggregates."""
    large = F.transform("vector", lambda x: F.abs(x.cast("double") * factor) + 1)
    square = F.aggregate(large, F.lit(0.0), lambda a, x: a + x * x)
    found = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims"), F.max(F.array_max(large)).alias("most"), F.max(square).alias("square")).first()
    dims, most, square = found.dims or 0, found.most or 1.0, found.square or 1.0
    if square >= 2.0**55:
        raise OverflowError("hundredfold scores of these vectors don't fit 64 bits")
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return Scale(found.n, dims, float(np.sqrt(square)) + 1, kind, square < 2.0**52)


def _packed(scale: Scale, factor: int):
    """Columns in: id, label, vector, anchor. Out: row (a number of its own), id, label, anchor, v."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = batch.column(2)
            n, sizes = len(vectors), np.diff(vectors.offsets.to_numpy())
            flat = np.floor(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * factor)
            table = np.zeros((n, scale.dims), scale.kind)
            table[np.arange(scale.dims) < sizes[:, None]] = flat
            raw = table.tobytes()
            width = scale.dims * table.itemsize
            v = [raw[i * width : (i + 1) * width] for i in range(n)]
            rows = pa.array(np.arange(at, at + n), pa.int64())
            at += n
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(1), batch.column(3), pa.array(v, pa.binary())], ["row", "id", "label", "anchor", "v"])

    return run


def _matrix(column: pa.Array, scale: Scale) -> np.ndarray:
    """Stored vectors as rows of whole numbers, in float64 where that is exact."""
    kind = np.float64 if scale.exact else np.int64
    if not len(column) * scale.dims:
        return np.zeros((len(column), scale.dims), kind)
    return np.frombuffer(b"".join(column.to_pylist()), scale.kind).reshape(len(column), scale.dims).astype(kind)


def _lifted(x: np.ndarray, scale: Scale, anchor: bool = False) -> np.ndarray:
    """Points of the metric space: with the further coordinate."""
    x = x.astype(np.float64)
    more = np.zeros(len(x)) if anchor else np.sqrt(np.maximum(scale.norm**2 - np.einsum("ij,ij->i", x, x), 0))
    return np.column_stack([x, more])


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", points, points)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Tree:
    """Nodes in order of making, the root first; a child below 0 is leaf -1 - child."""

    points: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def down(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(node, rows that reach it, their distances from its points, the child of each)."""
        waiting = [(0, np.arange(len(x)))] if self.points else []
        while waiting:
            node, rows = waiting.pop()
            far = _distances(x[rows], self.points[node])
            child = np.argmin(far, axis=1)
            yield node, rows, far, child
            for j, into in enumerate(self.children[node]):
                if into >= 0 and (child == j).any():
                    waiting.append((into, rows[child == j]))

    def towards(self) -> list[np.ndarray]:
        """For each node, the child that leads to each leaf, -1 where none does."""
        out = [np.full(self.leaves, -1) for _ in self.points]
        for node in reversed(range(len(self.points))):
            for j, into in enumerate(self.children[node]):
                out[node][(out[into] >= 0) if into >= 0 else -1 - into] = j
        return out

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for node, rows, _, child in self.down(x):
            into = np.array(self.children[node])[child]
            out[rows[into < 0]] = -1 - into[into < 0]
        return out


def fit(sample: np.ndarray, fanout: int = FANOUT, leaf: int = LEAF) -> Tree:
    """A tree of the sampled points."""
    tree = Tree([], [], 0)

    def split(x: np.ndarray) -> int:
        if len(x) > leaf:
            chosen = [0]
            near = _distances(x, x[:1])[:, 0]
            while len(chosen) < fanout and near.max() > 1e-6 * (1 + np.abs(x).max()):
                chosen.append(int(np.argmax(near)))
                near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
            child = np.argmin(_distances(x, x[chosen]), axis=1)
            if len(chosen) > 1 and np.bincount(child, minlength=len(chosen)).max() < len(x):
                node = len(tree.points)
                tree.points.append(x[chosen])
                tree.children.append([])
                tree.children[node] = [split(x[child == j]) for j in range(len(chosen))]
                return node
        tree.leaves += 1
        return -tree.leaves

    split(sample)
    return tree


def _routed(tree: Tree, scale: Scale):
    """Columns in and out: row, id, label, anchor, v; and the leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(_lifted(_matrix(batch.column(4), scale), scale))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])

    return run


def _reaches(tree: Tree, scale: Scale):
    """Columns in: leaf, v. Out: for each node, split point and sibling of this task's rows the least and the greatest distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        most = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
        towards = tree.towards()
        for batch in batches:
            leaf, x = batch.column(0).to_numpy(), _lifted(_matrix(batch.column(1), scale), scale)
            for node, points in enumerate(tree.points):
                child = towards[node][leaf]
                for j in np.unique(child[child >= 0]):
                    own = _distances(x[child == j], points)
                    least[node][:, j] = np.minimum(least[node][:, j], own.min(axis=0))
                    most[node][:, j] = np.maximum(most[node][:, j], own.max(axis=0))
        rows = [(n, i, j, least[n][i, j], most[n][i, j]) for n in range(len(least)) for i, j in zip(*np.nonzero(np.isfinite(least[n])), strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "i", "j", "least", "most"])

    return run


@dataclass
class Index:
    """The fitted tree, its ranges and the sample, all of bounded size, and the rows by leaf."""

    tree: Tree
    scale: Scale
    least: list[np.ndarray]
    most: list[np.ndarray]
    sample: dict[str, np.ndarray]
    shelf: np.ndarray  # of each leaf
    blocks: np.ndarray  # of each shelf
    rows: DataFrame | None

    def remaining(self, anchors: np.ndarray, near: np.ndarray, far: np.ndarray) -> list[np.ndarray]:
        """For each anchor the leaves that may have rows in one of its annuli (``near`` and ``far``: anchors by windows)."""
        found: list[list[int]] = [[] for _ in anchors]
        open_ = (near <= far).any(axis=1)
        if not self.tree.points:
            return [np.zeros(int(o), np.int64) for o in open_]
        slack = self.scale.slack
        waiting = [(0, np.flatnonzero(open_))]
        while waiting:
            node, own = waiting.pop()
            d = _distances(anchors[own], self.tree.points[node])[:, None, :, None]
            r1, r2 = near[own][:, :, None, None], far[own][:, :, None, None]
            reach = (self.least[node] <= d + r2 + slack) & (self.most[node] >= np.maximum(d - r2, r1 - d) - slack)
            stays = (reach.all(axis=2) & (near <= far)[own][:, :, None]).any(axis=1)
            for j, into in enumerate(self.tree.children[node]):
                left = own[stays[:, j]]
                if into >= 0 and len(left):
                    waiting.append((into, left))
                elif into < 0:
                    for a in left.tolist():
                        found[a].append(-1 - into)
        return [np.array(f, np.int64) for f in found]


def shelves(sizes: list[int], block: int) -> tuple[np.ndarray, np.ndarray]:
    """(shelf of each leaf, blocks of each shelf): runs of leaves with at most ``block`` rows, or one larger leaf."""
    shelf, held = [], []
    for n in sizes:
        if not held or held[-1] + n > block:
            held.append(0)
        held[-1] += n
        shelf.append(len(held) - 1)
    return np.array(shelf, np.int64), np.array([max(1, -(-n // block)) for n in held], np.int64)


def index(vectors: DataFrame, factor: int, sample: int = SAMPLE, block: int = BLOCK) -> Index | None:
    """All usable rows (id, label, vector, anchor) by leaf of a tree that is fitted on about ``sample`` of them; None without any."""
    scale = scale_of(vectors, factor)
    if not scale.rows:
        return None
    schema = "row long, id long, label long, anchor boolean, v binary"
    packed = stored(vectors.select("id", "label", "vector", "anchor").mapInArrow(lean(_packed(scale, factor)), schema), "vectors")
    drawn = packed.where(F.pmod(F.xxhash64("row"), F.lit(scale.rows)) < sample).select("row", "id", "label", "v").toArrow()
    columns = drawn.sort_by("row").combine_chunks()
    values = _matrix(columns["v"].combine_chunks(), scale)
    tree = fit(_lifted(values, scale))
    routed = stored(packed.mapInArrow(lean(_routed(tree, scale)), schema + ", leaf int"), "leaves")
    least = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    most = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    ranges = routed.select("leaf", "v").mapInArrow(lean(_reaches(tree, scale)), "node int, i int, j int, least double, most double")
    for r in ranges.groupBy("node", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():  # a number for each pair of siblings
        least[r.node][r.i, r.j], most[r.node][r.i, r.j] = r.least, r.most
    known = {"row": columns["row"].to_numpy(), "label": columns["label"].to_numpy(), "v": values}
    sizes = dict(routed.groupBy("leaf").agg(F.count("*")).collect())  # a number for each leaf
    shelf, blocks = shelves([sizes.get(leaf, 0) for leaf in range(tree.leaves)], block)
    return Index(tree, scale, least, most, known, shelf, blocks, routed)


def _whole(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a @ b.T).astype(np.int64)


def _asked(found: Index, same: bool, keep: int, sample_rows: int = 512):
    """Columns in: row, id, label, v, low, high (lists). Out: these, low raised by what the sample has, and the shelves of the leaves that remain."""
    tree_only = replace(found, rows=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, known = tree_only.scale, tree_only.sample
        for whole in batches:
            for first in range(0, whole.num_rows, sample_rows):
                batch = whole.slice(first, sample_rows)
                x = _matrix(batch.column(3), scale)
                low = np.array(batch.column(4).to_pylist(), np.int64).reshape(len(x), -1)
                high = np.array(batch.column(5).to_pylist(), np.int64).reshape(len(x), -1)
                score = _whole(x, known["v"])
                eligible = known["label"][None, :] == batch.column(2).to_numpy()[:, None]
                eligible = eligible & (known["row"][None, :] != batch.column(0).to_numpy()[:, None]) if same else ~eligible
                if score.shape[1] >= keep:
                    for w in range(low.shape[1]):
                        inside = np.where(eligible & (score >= low[:, w : w + 1]) & (score <= high[:, w : w + 1]), score, _NONE)
                        best = np.partition(inside, -keep, axis=1)[:, -keep]
                        low[:, w] = np.maximum(low[:, w], best)
                lifted = _lifted(x, scale, anchor=True)
                square = np.einsum("ij,ij->i", lifted, lifted)[:, None] + scale.norm**2
                edge = square  # no score is beyond half of this
                near, far = (np.sqrt(np.maximum(square - 2 * np.clip(s.astype(np.float64), -edge, edge), 0)) for s in (high, low))
                far[low > high] = -1  # nothing to look for
                asked = [np.unique(tree_only.shelf[leaves]) for leaves in tree_only.remaining(lifted, near, far)]
                lists = pa.list_(pa.int64())
                columns = [*batch.columns[:4], pa.array(list(low), lists), batch.column(5), pa.array(asked, lists)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "label", "v", "low", "high", "shelves"])

    return run


def _compared(scale: Scale, same: bool, keep: int):
    """The best ``keep`` rows of a block for each window of each anchor of a slot."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            rows, anchors = rows.combine_chunks(), anchors.combine_chunks()
            x = _matrix(rows["v"].combine_chunks(), scale)
            a = _matrix(anchors["v"].combine_chunks(), scale)
            row, label = rows["row"].to_numpy(), rows["label"].to_numpy()
            ids = rows["id"].fill_null(_ALL).to_numpy()
            own, own_label = anchors["row"].to_numpy(), anchors["label"].to_numpy()
            low, high = anchors["low"].to_pylist(), anchors["high"].to_pylist()
            score = _whole(a, x)
            for i in range(len(a)):
                fits = (label == own_label[i]) & (row != own[i]) if same else label != own_label[i]
                for w, (least, most) in enumerate(zip(low[i], high[i], strict=True)):
                    at = np.flatnonzero(fits & (score[i] >= least) & (score[i] <= most))
                    if len(at) > keep:
                        edge = np.partition(score[i][at], -keep)[-keep]
                        at = at[score[i][at] >= edge]
                        at = at[np.lexsort((row[at], ids[at], -score[i][at]))[:keep]]
                    out += [(own[i], w, score[i][k], ids[k], row[k]) for k in at]
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "window", "score", "other", "other_row"])

    return run


def search(found: Index, anchors: DataFrame, same: bool, keep: int, block: int = BLOCK) -> DataFrame:
    """anchor (row), window, nth, score and other (id) of the best ``keep`` rows in each window of each anchor.

    ``anchors`` has row, id, label, v, and the lists low and high; rows have the anchor's label if ``same``, else another.
    """
    asked = stored(
        anchors.select("row", "id", "label", "v", "low", "high").mapInArrow(
            lean(_asked(found, same, keep)), "row long, id long, label long, v binary, low array<long>, high array<long>, shelves array<long>"
        ),
        "asked",
    )
    asking = asked.withColumn("shelf", F.explode("shelves")).drop("shelves", "id")
    # One row for each leaf and each shelf of the tree; the sample bounds their number.
    spark = anchors.sparkSession
    leaves = F.broadcast(spark.createDataFrame(list(enumerate(found.shelf.tolist())), "leaf int, shelf long"))
    blocks = spark.createDataFrame(list(enumerate(found.blocks.tolist())), "shelf long, blocks int")
    counted = asking.groupBy("shelf").agg(F.ceil(F.count("*") / block).cast("int").alias("slots"))
    grid = F.broadcast(stored(blocks.join(counted, "shelf"), "grid"))
    key = ["shelf", "block", "slot"]

    def spread(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rows = found.rows.select("row", "id", "label", "v", "leaf").join(leaves, "leaf").join(grid, "shelf")
    rows = rows.withColumns({"block": F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"), "slot": spread("slots")}).drop("leaf", "blocks", "slots")
    asking = asking.join(grid, "shelf")
    asking = asking.withColumns({"slot": F.pmod(F.xxhash64("row"), F.col("slots")).cast("int"), "block": spread("blocks")}).drop("blocks", "slots")
    best = (
        rows.groupBy(*key)
        .cogroup(asking.groupBy(*key))
        .applyInArrow(_compared(found.scale, same, keep), "anchor long, window int, score long, other long, other_row long")
    )
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "other", "other_row")
    ranked = best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)
    return ranked.select("anchor", "window", "nth", "score", F.nullif("other", F.lit(_ALL)).alias("other"))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    factor: int = 256,
    id_col: str = "vec_id",
    label: Column | str = "label",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of its label the first ``negatives`` rows of another.

    A negative's score is within ``window`` per cent of the positive's; ``is_anchor`` and ``label`` are over the table's columns.
    """
    vector = F.col(f"`{vector_col}`")
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    source = vectors.where(usable(label, vector)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")
    )
    found = index(source, factor, sample, block)
    if found is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    anchors = found.rows.where("anchor").drop("leaf", "anchor")
    everything = {"low": F.array(F.lit(-_ALL)), "high": F.array(F.lit(_ALL))}
    near = stored(search(found, anchors.withColumns(everything), True, positives, block).drop("window"), "positives")

    # A window for each positive, by its place; places without one are empty windows.
    scores = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("own"))
    low = F.expr(f"transform(own, p -> (p.score * {window[0]} + pmod(-p.score * {window[0]}, 100L)) div 100)")
    high = F.expr(f"transform(own, p -> (p.score * {window[1]} - pmod(p.score * {window[1]}, 100L)) div 100)")

    def full(values: Column, filler: int) -> Column:
        return F.slice(F.concat(values, F.array_repeat(F.lit(filler).cast("long"), positives)), 1, positives)

    windows = scores.select(F.col("anchor").alias("row"), full(low, _ALL).alias("low"), full(high, -_ALL).alias("high"))
    hard = search(found, anchors.join(windows, "row"), False, negatives, block)
    hard = hard.select("anchor", (F.col("window") + 1).alias("nth"), F.col("nth").alias("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    with_ids = near.select("anchor", "nth", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")).join(ids, "anchor")
    return with_ids.join(hard, ["anchor", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
