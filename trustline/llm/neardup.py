"""Near-duplicate groups by b-bit MinHash.

Texts with equal words form a class, a node of the graph.  Bands of MinHash minima put nodes
into groups of candidates; of groups with equal members one is kept.  Nodes keep only the low
bits of their minima, packed; agreeing bits, corrected for those that agree by chance, estimate
the similarity of candidates:  J = (E - 2^-b) / (1 - 2^-b).  The estimate only picks which
pairs are confirmed, and only those far below the threshold (FLOOR_SIGMAS standard errors)
are passed over; a link always rests on the full shingle sets.

First each group is covered by stars: the member closest to the bits that most members have
is paired with all that look near it, then the rest likewise.  Links found join components.
What is left are pairs of one group that lie in different components; all of these that look
near are confirmed too, block by block, so no candidate is left out.  Large groups are split
into blocks of a fixed size, and no task holds more than two.

Defined cases: NULL and empty texts have no shingles and stay alone; a text with fewer words
than a shingle is one shingle.  Rows with equal ids may be in different components if their
texts differ.  A NULL id never becomes a component's id while another id is there; dropping goes
by components apart from ids, so one row of each stays also without ids or with repeated ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustline.llm.passages import pack_text, unpack_text
from trustline.llm.shared import lean, partitions, stored, tidy
from trustline.llm.words import SPACED_FOLDED, mix, raw_texts, rolling, scan, slices, whole

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5  # a pair at 0.8 is missed once in 10 million, one at 0.85 once in 10 billion
BITS = 2
HASHES = BANDS * ROWS
BLOCK = 2048  # members of a group compared at once
COLUMNS = 2048  # shingles counted at once for all members
FLOOR_SIGMAS = 5

_UINT32 = np.uint64(0xFFFFFFFF)
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_MULTIPLY = (_SEEDS[:HASHES] & _UINT32).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[HASHES:] & _UINT32).astype(np.uint32)


def shingles(hashes: np.ndarray, word_at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, row) for each distinct shingle of each row, sorted by row; a short text is one shingle."""
    found = rolling(hashes, k)
    inside = whole(word_at, len(hashes), k)
    row = np.searchsorted(word_at, np.arange(len(found)), side="right") - 1
    found, row = found[inside], row[inside]
    size = np.diff(word_at)
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        one = [rolling(hashes[word_at[r] : word_at[r + 1]], int(size[r]))[0] ^ np.uint64(size[r]) for r in short.tolist()]
        found, row = np.concatenate([found, mix(np.array(one, np.uint64))]), np.concatenate([row, short])
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], row[new]


def minima(found: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """n x HASHES minima; rows without shingles have the highest value."""
    out = np.full((n, HASHES), np.uint32(0xFFFFFFFF), np.uint32)
    if len(found):
        at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        low = (found >> np.uint64(32)).astype(np.uint32)
        held = row[at]
        for j in range(HASHES):
            out[held, j] = np.minimum.reduceat(low * _MULTIPLY[j] + _ADD[j], at)
    return out


def packed_bits(values: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, n x (HASHES * BITS / 8) bytes."""
    low = (values[:, :, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(low.astype(np.uint8).reshape(len(values), -1), axis=1)


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How many of the HASHES low-bit values of each row of ``many`` equal those of ``one``."""
    differ = np.bitwise_xor(many, one)
    either = differ.copy()
    for j in range(1, BITS):
        either |= differ << np.uint8(j)
    return HASHES - np.bitwise_count(either & _TOP).sum(axis=-1, dtype=np.int64)


# The first bit of each packed value; a value differs if any of its bits does.
_TOP = np.uint8(sum(1 << (7 - i) for i in range(0, 8, BITS)))


def estimate(agreeing: np.ndarray) -> np.ndarray:
    chance = 2.0**-BITS
    return (agreeing / HASHES - chance) / (1 - chance)


def floor_of(threshold: float) -> float:
    chance = 2.0**-BITS
    seen = threshold + (1 - threshold) * chance
    return threshold - FLOOR_SIGMAS * (seen * (1 - seen) / HASHES) ** 0.5 / (1 - chance)


def band_keys(values: np.ndarray) -> np.ndarray:
    """n x BANDS 64-bit keys."""
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(17)), (len(values), BANDS)).copy()
    for j in range(ROWS):
        key = mix((key ^ values[:, j::ROWS].astype(np.uint64)).ravel()).reshape(key.shape)
    return key


def nodes(hashes: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """64-bit identity of each row's word sequence."""
    size = np.diff(word_at)
    place = np.arange(len(hashes)) - np.repeat(word_at[:-1], size)
    total = np.zeros(len(size), np.uint64)
    if len(hashes):
        full = np.flatnonzero(size)
        total[full] = np.add.reduceat(mix(hashes + mix(place.astype(np.uint64))), word_at[:-1][full])
    return mix(total + size.astype(np.uint64)).view(np.int64)


# -- signatures -------------------------------------------------------------------------------


def _describe(k: int):
    """Columns in: id, key, text_hash, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3), SPACED_FOLDED):
                found, row = shingles(part.hashes, part.word_at, k)
                least = minima(found, row, part.count)
                keys = pa.array(band_keys(least).view(np.int64).ravel(), pa.int64())
                bits = packed_bits(least)
                rows = slice(part.first, part.first + part.count)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i)[rows] for i in range(3)),
                        pa.array(nodes(part.hashes, part.word_at), pa.int64()),
                        pa.array(np.bincount(row, minlength=part.count), pa.int64()),
                        pa.array([x.tobytes() for x in bits], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(part.count + 1) * BANDS, pa.int32()), keys),
                    ],
                    ["id", "key", "text_hash", "node", "n_shingles", "bits", "bands"],
                )

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: id, key, text_hash, text. Out: key, node, packed text."""
    for batch in batches:
        for part in slices(batch.column(3), SPACED_FOLDED):
            raw, at = part.raw.tobytes(), part.text_at.tolist()
            packed = [pack_text(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[part.first : part.first + part.count], pa.array(nodes(part.hashes, part.word_at), pa.int64()), pa.array(packed, pa.binary())], ["key", "node", "packed"]
            )


# -- candidate pairs --------------------------------------------------------------------------


def _plain(column: pa.Array) -> np.ndarray:
    if not (pa.types.is_binary(column.type) or pa.types.is_list(column.type)):
        return column.to_numpy(zero_copy_only=False)
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _by_key(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """The columns of each run of rows with equal first ``n_keys`` columns; the rows are sorted by them."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> tuple[list[list[np.ndarray]], pa.Table]:
        plain = [_plain(c.combine_chunks()) for c in table.columns]
        keys = plain[:n_keys]
        edge = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1 if len(plain[0]) else np.empty(0, int)
        edge = [0, *edge.tolist(), len(plain[0])]
        return [[c[a:b] for c in plain] for a, b in zip(edge[:-2], edge[1:-1], strict=True)], table.slice(edge[-2])

    for batch in batches:
        if batch.num_rows:
            groups, rest = cut(pa.Table.from_batches([*held, batch]))
            yield from groups
            held = rest.combine_chunks().to_batches()
    if held:
        yield [_plain(c.combine_chunks()) for c in pa.Table.from_batches(held).columns]


def _matrix(bits: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)


def _centre(bits: np.ndarray) -> int:
    """The row that agrees most with the bits that most rows have."""
    flat = np.unpackbits(bits, axis=1)
    usual = np.packbits(flat.mean(axis=0) >= 0.5)
    return int(np.argmax(agreement(usual, bits)))


def _pair_batch(left: list, right: list) -> pa.RecordBatch:
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _stars(floor: float):
    """Columns in, sorted: key, block, node, bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, size = [], [], 0
        for _, _, node, bits in _by_key(batches, 2):
            table = _matrix(bits)
            while len(node) > 1:
                at = _centre(table) if len(node) > 2 else 0
                near = estimate(agreement(table[at], table)) >= floor
                near[at] = True
                others = node[near & (node != node[at])]
                left.append(np.full(len(others), node[at]))
                right.append(others)
                size += len(others)
                node, table = node[~near], table[~near]
            if size > 50_000:
                yield _pair_batch(left, right)
                left, right, size = [], [], 0
        yield _pair_batch(left, right)

    return run


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (left, right) of sets, each sorted."""
    sizes = np.array([len(x) for x in sets])
    value, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    many = seen > 1
    if len(left) * (sizes.mean() + 500) < len(sets) ** 2 * many.sum() / 100:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left.tolist(), right.tolist(), strict=True)])
    shared = many[column]
    row, column = row[shared], (np.cumsum(many) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(many.sum()), COLUMNS):
        low, high = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[row[low:high], column[low:high] - at] = 1
        total += has @ has.T
    return total[left, right].astype(np.int64)


def _crossing(k: int, floor: float, threshold: float):
    """Columns in, sorted: band, low, high, nth, block, node, component, bits, bands, packed text.

    Out: the links between two blocks of a group, in different components.  A pair is looked
    at in the first band that its members share, and pairs that look near are confirmed on
    their full sets right here, so only links leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, low, high, nth, block, node, component, bits, bands, packed in _by_key(batches, 3):
            table, one, first = _matrix(bits), block == low[0], int(nth[0])
            earlier = np.array(bands.tolist(), np.int64).reshape(len(node), BANDS)[:, :first]
            within = low[0] == high[0]
            left, right = [], []
            for at in np.flatnonzero(one).tolist():
                able = np.flatnonzero((component != component[at]) & ((node > node[at]) if within else ~one))
                able = able[estimate(agreement(table[at], table[able])) >= floor]
                able = able[~(earlier[able] == earlier[at]).any(axis=1)]
                left.append(np.full(len(able), at))
                right.append(able)
            left, right = np.concatenate(left) if left else np.empty(0, int), np.concatenate(right) if right else np.empty(0, int)
            if not len(left):
                continue
            used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
            sets = [text_set(unpack_text(packed[i]), k) for i in used.tolist()]
            left, right = place[: len(left)], place[len(left) :]
            both = _intersections(sets, left, right)
            sizes = np.array([len(x) for x in sets])
            near = 10_000 * both >= round(threshold * 10_000) * (sizes[left] + sizes[right] - both)
            if near.any():
                yield _pair_batch([node[used[left[near]]]], [node[used[right[near]]]])

    return run


def text_set(text: bytes, k: int) -> np.ndarray:
    """The distinct shingles of one text, sorted."""
    raw = np.frombuffer(text, np.uint8)
    hashes = scan(raw, np.array([0, len(raw)]), SPACED_FOLDED)[2]
    return shingles(hashes, np.array([0, len(hashes)]), k)[0]


def _confirm(k: int, threshold: float):
    """Columns in: a, b, packed text of a, of b. Out: the pairs whose shingle sets are similar enough."""
    per_cent = round(threshold * 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.empty(0, np.uint64)
        for batch in batches:
            left, right = [], []
            for a, b, one, two in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if a != last:
                    last, mine = a, text_set(unpack_text(one), k)
                other = text_set(unpack_text(two), k)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if 10_000 * both >= per_cent * (len(mine) + len(other) - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


# -- components -------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all linked nodes: the smallest node that each can reach.

    Large and small stars in turn: every node hands its larger neighbours, then its smaller
    ones, to the smallest it knows, until nothing changes.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(moved.select("e.*").where("u <> v").distinct(), "edges")
        tidy(edges.sparkSession)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    label = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stored(label.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components")


def find_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """One row per document: id, key, text_hash, n_shingles, component (the smallest id it is linked to, over any number of links)."""
    return _grouped(docs, id_col, text_col, threshold, shingle, block).drop("group")


def _grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """``find_groups`` with the component's own number, group, that needs no ids; NULL for texts without shingles."""
    spark = docs.sparkSession
    n, floor = partitions(spark), floor_of(threshold)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    source = docs.select(ident.alias("id"), F.coalesce(ident, F.xxhash64(text)).alias("key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    described = stored(source.mapInArrow(lean(_describe(shingle)), "id long, key long, text_hash long, node long, n_shingles long, bits binary, bands array<long>"), "signatures")
    base = described.select("id", "key", "text_hash", "node", "n_shingles")

    full = described.where("n_shingles > 0")
    first = full.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first")).select("node", "first.id", "first.key")
    # One row of each class: later rows of it have another key, or equal the first in all that counts here.
    own = full.select("node", "key", "bits", "bands").join(first.select("node", "key"), ["node", "key"]).dropDuplicates(["node"])
    keyed = own.select("node", F.posexplode("bands").alias("nth", "band"))
    groups = keyed.groupBy("nth", "band").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("members")).where("size > 1")
    # Of groups with the same members the first band's stays, so a pair's first common band is always there.
    groups = groups.groupBy("size", "members").agg(F.min(F.struct("nth", "band")).alias("g")).select("g.nth", "g.band", "size")
    member = stored(
        keyed.join(groups, ["nth", "band"]).join(own.select("node", "bits"), "node").select(
            "nth", "band", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / block)).cast("int").alias("block"), F.ceil(F.col("size") / block).cast("int").alias("blocks"), "node", "bits"
        ),
        "members",
    )
    tidy(spark)
    wanted = member.select("node").distinct().join(first, "node").select("node", "key")
    texts = stored(source.mapInArrow(lean(_texts), "key long, node long, packed binary").join(wanted, ["key", "node"]).select("node", "packed").dropDuplicates(["node"]), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("two")), "b")
        both = with_b.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("one")), "a")
        return both.select("a", "b", "one", "two").mapInArrow(lean(_confirm(shingle, threshold)), "a long, b long")

    stars = member.select("band", "block", "node", "bits").repartition(n, "band", "block").sortWithinPartitions("band", "block")
    links = stored(confirmed(stars.mapInArrow(lean(_stars(floor)), "a long, b long")), "links")
    tidy(spark)
    label = components(links)

    # Groups that still span components: every pair of their blocks meets once.
    placed = member.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("band").agg((F.min("component") < F.max("component")).alias("mixed")).where("mixed").select("band")
    spread = placed.join(mixed, "band").join(own.select("node", "bands"), "node").join(texts, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    spread = spread.select("band", *pair, "nth", "block", "node", "component", "bits", F.col("bands"), "packed")
    spread = spread.repartition(n, "band", "low", "high").sortWithinPartitions("band", "low", "high")
    rest = stored(spread.mapInArrow(lean(_crossing(shingle, floor, threshold)), "a long, b long"), "links")
    tidy(spark)
    if not rest.isEmpty():
        label = components(links.unionByName(rest))

    of_node = label.join(first.select("node", "id"), "node")
    least = of_node.groupBy("component").agg(F.min("id").alias("least"))
    linked = of_node.join(least, "component").select("node", "least", F.col("component").alias("group"))
    alone = first.join(linked.select("node"), "node", "left_anti").select("node", F.col("id").alias("least"), F.col("node").alias("group"))
    named = linked.unionByName(alone)
    lone = base.where("n_shingles = 0").select("id", "key", "text_hash", "n_shingles", F.col("id").alias("component"), F.lit(None).cast("long").alias("group"))
    grouped = base.where("n_shingles > 0").join(named, "node").select("id", "key", "text_hash", "n_shingles", F.col("least").alias("component"), "group")
    return grouped.unionByName(lone)


def keeps(ident: Column, component: Column) -> Column:
    """Whether a document stands for its component."""
    return ident.eqNullSafe(component)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, whole and with all its columns: the one with the smallest id (NULL last), then text hash.

    Of rows alike in id and text one stays; texts without shingles all stay.
    """
    same = ["no_id", "key", "text_hash"]
    alike = _grouped(docs, id_col, text_col, **options).where("group is not null").groupBy("group", F.col("id").isNull().alias("no_id"), "key", "text_hash").agg(F.count("*").alias("n"))
    first = alike.groupBy("group").agg(F.min(F.struct(*same)).alias("first")).select("first.*").withColumn("stays", F.lit(True))
    # Not as they are in the result: rows that go, and those of which one stays.
    other = stored(alike.join(first, same, "left").select(*same, F.coalesce("stays", F.lit(False)).alias("stays"), "n").where("n > 1 or not stays"), "gone")
    ident, text_hash = F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    columns = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*columns, ident.isNull().alias("no_id"), F.coalesce(ident, text_hash).alias("key"), text_hash.alias("text_hash"))
    values = [f"k{i}" for i in range(len(columns))]
    single = rows.join(other.select(*same), same, "left_anti").select(*values)
    repeated = rows.join(other.where("stays").select(*same), same)
    least = repeated.groupBy(*same).agg(F.min_by(F.struct(*values), F.xxhash64(*values)).alias("row")).select("row.*")
    return single.unionByName(least).toDF(*docs.columns)
