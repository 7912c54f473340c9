"""Substring dedup: recurring passages confirmed by sharded Aho-Corasick automata.

A window is a run of consecutive words.  A word goes if a window that covers it also starts
in a document with a smaller id.

1. Texts with equal words form a class; only its first document is searched, the others
   repeat it whole.
2. Every window has an anchor, its smallest hash of a few words, so equal windows have equal
   anchors.  Anchors (about a quarter of the words) are dealt by hash; those of two or more
   classes mark the windows that may recur.
3. Hashes of the marked windows are dealt likewise, which names for each recurring window an
   owner: an earlier document that has it.
4. The owners' passages are compiled into Aho-Corasick automata over words, a shard for each
   few thousand windows of an owner.  The passages of all documents that the hashes point to
   are streamed through them, which confirms and locates every occurrence by its very words.
   A popular owner's stream is salted over many tasks.

Tasks hold distinct hashes of their share, never all copies of a hot one.

Defined cases: NULL and empty texts have no words and come back empty; rows with equal ids
are one document and never remove words from each other; a NULL id comes after all ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.llm.shared import lean, partitions, stored
from trustline.llm.words import SPACED, mix, raw_texts, rolling, scan, slices, whole

WINDOW = 13
ANCHOR = 7  # words of an anchor
HELD = 1 << 20  # entries that a task gathers before it sorts them
DEALT_ROWS = 1 << 19  # entries dealt at once
SHARD_BITS = 12  # an automaton has the windows that start in so many bits of an owner's words
STREAM = 20_000  # passages that one task streams through an automaton
LAST = np.iinfo(np.int64).max

_CODEC = "zstd"


def pack(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec=_CODEC, asbytes=True)


def unpack(blob: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    sizes = [n * np.dtype(k).itemsize for k in kinds]
    raw = pa.decompress(blob, decompressed_size=sum(sizes), codec=_CODEC, asbytes=True)
    ends = np.cumsum(sizes)
    return [np.frombuffer(raw[e - s : e], k) for e, s, k in zip(ends, sizes, kinds, strict=True)]


def pack_text(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + (pa.compress(text, codec=_CODEC, asbytes=True) if text else b"")


def unpack_text(blob: bytes) -> bytes:
    n = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], decompressed_size=n, codec=_CODEC, asbytes=True) if n else b""


def class_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each anchor candidate, place of the anchor of each window)."""
    each = rolling(hashes, ANCHOR)
    span = window - ANCHOR + 1
    n = len(each) - span + 1
    if n <= 0:
        return each, np.empty(0, np.int64)
    least = each[:n].copy()
    for j in range(1, span):
        np.minimum(least, each[j : n + j], out=least)
    place = np.zeros(n, np.int64)
    for j in range(1, span):
        place[each[j : n + j] == least] = j
    return each, place + np.arange(n)


def _dealt(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _deal(hashes: np.ndarray, n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row for each share of the hashes."""
    to = _dealt(hashes, n)
    order = np.argsort(to, kind="stable")
    hashes, arrays = hashes[order], [a[order] for a in arrays]
    edge = np.searchsorted(to[order], np.arange(n + 1))
    rows = [(b, edge[b + 1] - edge[b], pack(hashes[edge[b] : edge[b + 1]], *(a[edge[b] : edge[b + 1]] for a in arrays))) for b in np.flatnonzero(np.diff(edge))]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(r[0]) for r in rows], pa.int32()), pa.array([int(r[1]) for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["share", "n", "entries"]
    )


def _deal_all(found: list[tuple], n: int) -> pa.RecordBatch:
    hashes, *arrays = (np.concatenate(x) for x in zip(*found, strict=True))
    return _deal(hashes, n, *arrays)


_DEALT = "share int, n int, entries binary"


def _gathered(rows: Iterator[tuple[int, bytes]], kinds: tuple[str, ...], settle: Callable, held: int) -> Iterator[pa.RecordBatch]:
    """Feed packed rows to ``settle(arrays) -> (arrays to keep, batch to emit)``, ``held`` entries at a time."""
    kept, fresh, size, most = None, [], 0, held
    for n, blob in rows:
        fresh.append(unpack(blob, n, *kinds))
        size += n
        if size >= most:
            kept, out = settle(kept, [np.concatenate(x) for x in zip(*fresh, strict=True)])
            yield out
            fresh, size = [], 0
            most = max(held, len(kept[0]))
    if fresh:
        yield settle(kept, [np.concatenate(x) for x in zip(*fresh, strict=True)])[1]


def _dealt_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins; keys are sorted."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _spread(keys: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64))


def _runs(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    ends = np.append(at, len(values))[1:]
    return [values[a:b].astype(np.int32).tobytes() for a, b in zip(at.tolist(), ends.tolist(), strict=True)]


# -- 1: texts as classes ---------------------------------------------------------------------


def _describe(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = raw_texts(batch.column(2))
            raw, digests, sizes, packed = memoryview(raw), [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                words = bytes(raw[a:b]).split()
                joined = b" ".join(words)
                digests.append(hashlib.sha256(joined).digest())
                sizes.append(len(words))
                if with_text:
                    packed.append(pack_text(joined))
            classes = pa.array([class_of(d) for d in digests], pa.int64())
            if with_text:
                columns, names = [batch.column(1), classes, pa.array(packed, pa.binary())], ["key", "class", "packed"]
            else:
                columns = [batch.column(0), batch.column(1), classes, pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())]
                names = ["id", "key", "class", "digest", "n_words"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


# -- 2: anchors -------------------------------------------------------------------------------


def _emit_anchors(window: int, n_shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, classes, places = [], [], []
            raw, at = raw_texts(batch.column(2))
            view = memoryview(raw)
            own = np.array([class_of(hashlib.sha256(b" ".join(bytes(view[a:b]).split())).digest()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.int64)
            for part in slices(batch.column(2), SPACED):
                each, place = anchors(part.hashes, window)
                place = np.unique(place[whole(part.word_at, len(part.hashes), window)])
                row = np.searchsorted(part.word_at, place, side="right") - 1
                hashes.append(each[place])
                classes.append(own[part.first + row])
                places.append((place - part.word_at[row]).astype(np.int32))
                if sum(map(len, hashes)) > DEALT_ROWS:
                    yield _deal(np.concatenate(hashes), n_shares, np.concatenate(classes), np.concatenate(places))
                    hashes, classes, places = [], [], []
            if hashes:
                yield _deal(np.concatenate(hashes), n_shares, np.concatenate(classes), np.concatenate(places))

    return run


def _recurring_anchors(held: int, n_shares: int):
    def settle(kept, fresh):
        h, c, p = fresh
        first = np.zeros(len(h), bool)  # stands for a hash that is known to recur
        if kept is not None:
            h, c, p, first = (np.concatenate(x) for x in zip(kept, (h, c, p, first), strict=True))
        order = np.lexsort((p, c, ~first, h))
        h, c, p, first = h[order], c[order], p[order], first[order]
        own = np.zeros(len(h), bool)
        own[_groups(h, c, p, first)] = True
        h, c, p, first = h[own], c[own], p[own], first[own]
        at = _groups(h)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h))))
        again = (np.minimum.reduceat(c, at) < np.maximum.reduceat(c, at)) | first[at] if len(at) else np.zeros(0, bool)
        out = again[group] & ~first
        batch = _deal(_spread(c[out]), n_shares, c[out], p[out])
        single = ~again[group]
        mark = at[again]
        keep = (np.concatenate([h[single], h[mark]]), np.concatenate([c[single], c[mark]]), np.concatenate([p[single], p[mark]]), np.concatenate([first[single], np.ones(len(mark), bool)]))
        return keep, batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(_dealt_rows(batches), ("u8", "i8", "i4"), settle, held)

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All places of each class of this share, packed in one row."""
    parts = [unpack(blob, n, "u8", "i8", "i4") for n, blob in _dealt_rows(batches)]
    if parts:
        _, c, p = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((p, c))
        c, p = c[order], p[order]
        own = _groups(c)
        yield pa.RecordBatch.from_arrays([pa.array(c[own], pa.int64()), pa.array(_runs(p, own), pa.binary())], ["class", "at"])


# -- 3: windows and their owners --------------------------------------------------------------


def _hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    return scan(raw, np.array([0, len(raw)]), SPACED)[2]


def _emit_windows(window: int, n_shares: int):
    """Columns in: class, rank, packed, at (packed places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for own, rank, packed, marks in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                hashes = _hashes(unpack_text(packed))
                _, place = anchors(hashes, window)
                marked = np.zeros(len(hashes) + 1, bool)
                marked[np.frombuffer(marks, np.int32)] = True
                at = np.flatnonzero(marked[place])
                found.append((rolling(hashes, window)[at], np.full(len(at), rank), np.full(len(at), own), at.astype(np.int32)))
                size += len(at)
                if size > DEALT_ROWS:
                    yield _deal_all(found, n_shares)
                    found, size = [], 0
            if found:
                yield _deal_all(found, n_shares)

    return run


def _owned(held: int, n_shares: int):
    """For every window of a document with a larger rank than another that has it: where it is, and where in such an earlier one.

    Out, dealt by class: class, tag (1: a window to find, 0: the owner's), owner, shard of the owner, place.
    """

    def settle(kept, fresh):
        if kept is not None:
            fresh = [np.concatenate(x) for x in zip(kept, fresh, strict=True)]
        h, r, c, p = fresh
        order = np.lexsort((p, c, r, h))
        h, r, c, p = h[order], r[order], c[order], p[order]
        at = _groups(h)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(h))))
        later = r > r[at][group]
        owner, place = c[at][group][later], p[at][group][later]
        shard = place >> SHARD_BITS
        asked = _distinct(
            np.concatenate([c[later], owner]),
            np.concatenate([np.ones(len(owner), np.int32), np.zeros(len(owner), np.int32)]),
            np.concatenate([owner, owner]),
            np.concatenate([shard, shard]),
            np.concatenate([p[later], place]),
        )
        keep = ~later  # an earlier document may still come
        return (h[keep], r[keep], c[keep], p[keep]), _deal(_spread(asked[0]), n_shares, *asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(_dealt_rows(batches), ("u8", "i8", "i8", "i4"), settle, held)

    return run


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = _groups(*columns)
    return [c[new] for c in columns]


_ASKED = ("i8", "i4", "i8", "i4", "i4")


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All that is asked of each class of this share, packed in one row."""
    parts = [unpack(blob, n, "u8", *_ASKED)[1:] for n, blob in _dealt_rows(batches)]
    if parts:
        columns = _distinct(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        edge = np.append(_groups(columns[0]), len(columns[0])).tolist()
        rows = [(int(columns[0][a]), b - a, pack(*(c[a:b] for c in columns))) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["class", "n", "asked"])


# -- 4: automata ------------------------------------------------------------------------------


def _stretches(at: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """(first word, words) of the runs of consecutive windows."""
    at = np.unique(at)
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(at)).tolist(), strict=True):
        if b > a:
            yield int(at[a]), int(at[b - 1] - at[a]) + window


def _emit_passages(window: int):
    """Columns in: class, packed, n, asked. Out: passages of owners (tag 0) and of others (tag 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, packed, n, asked in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words = unpack_text(packed).split(b" ")
                _, tag, owner, shard, at = unpack(asked, n, *_ASKED)
                edge = np.append(_groups(tag, owner, shard), n).tolist()
                for a, b in zip(edge[:-1], edge[1:], strict=True):
                    for first, size in _stretches(at[a:b], window):
                        out.append((int(owner[a]), int(shard[a]), int(tag[a]), own, first, b" ".join(words[first : first + size])))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["owner", "shard", "tag", "class", "first", "words"])

    return run


class PhraseAutomaton:
    """Finds every window of the given passages, word by word."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.ready = False

    def add(self, passage: bytes) -> None:
        codes = tuple(self.codes.setdefault(w, len(self.codes) + 1) for w in passage.split(b" "))
        for i in range(len(codes) - self.window + 1):
            self.machine.add_word(codes[i : i + self.window], 1)

    def starts(self, passage: bytes) -> list[int]:
        if not self.ready:
            self.machine.make_automaton()
            self.ready = True
        if not len(self.machine):
            return []
        codes = tuple(self.codes.get(w, 0) for w in passage.split(b" "))
        return [end - self.window + 1 for end, _ in self.machine.iter(codes)]


def _locate(window: int):
    """Columns in, sorted: owner, shard, salt, tag, class, first, words. An owner's passages come before the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, machine = None, None
        for batch in batches:
            classes, places = [], []
            for owner, shard, salt, tag, own, first, words in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if (owner, shard, salt) != current:
                    current, machine = (owner, shard, salt), PhraseAutomaton(window)
                if tag == 0:
                    machine.add(words)
                elif starts := machine.starts(words):
                    classes.append(own)
                    places.append((np.array(starts, np.int32) + np.int32(first)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(places, pa.binary())], ["class", "at"])

    return run


def _cut(window: int):
    """Columns in: class, packed, at (list of packed window starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, packed, marks in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                joined = unpack_text(packed)
                words = joined.split(b" ")
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.concatenate([np.frombuffer(m, np.int32) for m in marks]))
                edge[at] += 1
                edge[at + window] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                spans = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                rows.append((own, hashlib.sha256(joined).digest(), int(gone.sum()), [{"word": a, "words": b - a} for a, b in spans.tolist()], kept.decode("utf-8", "replace")))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32())])), pa.string())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["class", "digest", "n_removed", "spans", "kept"])

    return run


_SPANS = "array<struct<word:int,words:int>>"


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, held: int = HELD, stream: int = STREAM) -> DataFrame:
    """One row per document: id, n_words, digest (SHA-256 of its words joined by spaces), n_removed, spans, kept.

    ``spans`` are the removed runs of words; ``kept`` is the text left, words joined by one
    space, and NULL where nothing is removed, so that the digest stands for it.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    source = docs.select(ident.alias("id"), F.coalesce(ident, F.xxhash64(text)).alias("key"), text.alias("text"))
    base = stored(source.mapInArrow(lean(_describe(False)), "id long, key long, class long, digest binary, n_words long"), "texts")
    first = base.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"))
    first = first.select("class", F.coalesce("first.id", F.lit(int(LAST))).alias("rank"), F.col("first.key").alias("key"))

    marks = source.mapInArrow(lean(_emit_anchors(window, n)), _DEALT).repartitionById(n, "share").mapInArrow(lean(_recurring_anchors(held, n)), _DEALT)
    marked = marks.repartitionById(n, "share").mapInArrow(lean(_marks), "class long, at binary").join(first, "class")
    texts = source.mapInArrow(lean(_describe(True)), "key long, class long, packed binary")
    searched = stored(texts.join(marked, ["key", "class"]).select("class", "rank", "packed", "at"), "searched")

    windows = searched.mapInArrow(lean(_emit_windows(window, n)), _DEALT).repartitionById(n, "share")
    asked = windows.mapInArrow(lean(_owned(held, n)), _DEALT).repartitionById(n, "share").mapInArrow(lean(_asked), "class long, n int, asked binary")
    passages = searched.join(asked, "class").select("class", "packed", "n", "asked").mapInArrow(
        lean(_emit_passages(window)), "owner long, shard int, tag int, class long, first int, words binary"
    )
    passages = stored(passages, "passages")

    # Owners whose passages are streamed by more than one task.
    load = passages.groupBy("owner", "shard").agg((F.sum("tag") / stream).cast("int").alias("more")).where("more > 0")
    salted = passages.join(load, ["owner", "shard"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
    salted = salted.withColumn(
        "salt",
        F.explode(F.when(F.col("tag") == 0, F.sequence(F.lit(0), F.col("more"))).otherwise(F.array(F.pmod(F.xxhash64("class", "first"), F.col("more") + 1).cast("int")))),
    )
    order = ["owner", "shard", "salt", "tag"]
    streams = salted.select(*order, "class", "first", "words").repartition(n, "owner", "shard", "salt").sortWithinPartitions(*order)
    located = streams.mapInArrow(lean(_locate(window)), "class long, at binary").groupBy("class").agg(F.collect_list("at").alias("at"))
    cut = searched.select("class", "packed").join(located, "class").mapInArrow(lean(_cut(window)), f"class long, digest binary, n_removed long, spans {_SPANS}, kept string")
    cut = cut.dropDuplicates(["class", "digest"]).drop("class")

    repeated = base.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    rows = base.drop("key", "class").join(repeated, "digest", "left")
    copy = F.coalesce((F.col("first_id") < F.col("id")) | (F.col("id").isNull() & F.col("first_id").isNotNull()), F.lit(False))
    all_gone = F.when(F.col("n_words") >= window, F.col("n_words")).otherwise(0)
    rows = rows.withColumn("copy", copy)
    whole_span = F.when(F.col("n_words") >= window, F.array(F.struct(F.lit(0).alias("word"), F.col("n_words").cast("int").alias("words")))).otherwise(F.array().cast(_SPANS))
    copies = rows.where("copy").select(
        "id", "n_words", "digest", all_gone.alias("n_removed"), whole_span.alias("spans"), F.when(F.col("n_words") >= window, F.lit("")).alias("kept")
    )
    others = rows.where("not copy").join(cut, "digest", "left").select(
        "id", "n_words", "digest", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"), "kept"
    )
    return others.unionByName(copies)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Id and text left of each document that loses words."""
    found = find_repeats(docs, id_col, text_col, **options).where("n_removed > 0")
    return found.select(F.col("id").alias(id_col), F.col("kept").alias(text_col))
