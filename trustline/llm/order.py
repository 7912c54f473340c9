"""Token-ID output in training order.

Texts are encoded, closed with an end token and cut into sequences of fixed length.  Sequence
i of N goes to slot P(i), where P is a keyed Feistel permutation of [0, N): a few rounds over
the next larger power of four, walked on along the cycle until the value is below N.  Slots
are dealt to shards by range, each shard is one binary file of records with a fixed stride,
so slot s is at byte (s mod per_shard) * stride of shard s / per_shard: a reader goes through
the files in order and resumes anywhere.

Texts are encoded once: each task stores its sequences in packs, numbered from the task's first
one, and one number for each task turns these into places in the whole.  Then slots are written
in PASSES ranges, one after another: a pass reads the packs, shuffles the sequences whose slots
it covers, several shards to a task, and its shuffle files go before the next begins; so there
is never more than a part of the corpus in them.  Files are written by Spark's own commit
protocol: a record ends with a line feed, the line separator of the text sink.

Record, little-endian: doc_id int64, sequence within the document int32, tokens int16, the
token ids (uint16, or uint32 for vocabularies that need it), padding, a line feed.

Defined cases: a NULL or empty text is one sequence that holds the end token alone; a NULL id
is written as the lowest int64 and read back as NULL; repeated rows are separate sequences;
an empty table gives no shards.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustline.llm.shared import lean, partitions, stored, work_folder
from trustline.llm.tokens import PIECES
from trustline.llm.words import mix
from trustline.sources.tables import exists

SEQUENCE = 256
SHARD_BYTES = 16 << 20
KEY = 20_240_229
ROUNDS = 6
HEAD = 14
PACK_BYTES = 1 << 20  # of ids in a pack
PASSES = 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NO_ID = np.iinfo(np.int64).min


def permute(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of the given places among ``n``: a permutation of [0, n) that the key selects."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.uint64(key) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[tiktoken.Encoding, int]:
    """The encoding of a rank file, and the id of the end token: the first one free."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def _kind(end: int) -> np.dtype:
    return np.dtype("<u2" if end < 1 << 16 else "<u4")


def stride_of(length: int, kind: np.dtype) -> int:
    return HEAD + length * kind.itemsize + 2


def _packs(path: str, length: int):
    """Columns in: id, text. Out: part, before (sequences of the task so far), n, size and blob of each pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = encoder(path)
        encode, kind = encoding.encode_ordinary, _kind(end)
        code = "H" if kind.itemsize == 2 else "I"
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            tokens, sizes, held, first = [], [], 0, 0

            def packed(rows: slice) -> pa.RecordBatch:
                nonlocal before
                own = np.array(sizes)
                count = -(-own // length)
                doc = np.repeat(np.arange(len(own)), count)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                size = np.minimum(length, np.repeat(own, count) - nth * length)
                heads = (ids[rows][doc], nth.astype(np.int32), size.astype(np.int16))  # noqa: B023
                blob = b"".join([*(x.tobytes() for x in heads), *tokens])
                columns = [[part], [before], [len(doc)], [len(blob)], [pa.compress(blob, codec="zstd", asbytes=True)]]
                before += len(doc)
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _PACK_KINDS, strict=True)], _PACK_NAMES)

            for row, text in enumerate(batch.column(1)):
                own = array(code, encode(text.as_py() or ""))
                own.append(end)
                tokens.append(own.tobytes())
                sizes.append(len(own))
                held += len(tokens[-1])
                if held >= PACK_BYTES:
                    yield packed(slice(first, row + 1))
                    tokens, sizes, held, first = [], [], 0, row + 1
            if sizes:
                yield packed(slice(first, None))

    return run


_PACK_NAMES = ["part", "before", "n", "size", "blob"]
_PACK_KINDS = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
_PACK = "part int, before long, n int, size long, blob binary"


def _deal(first: dict[int, int], n: int, key: int, per_shard: int, low: int, high: int, kind: np.dtype):
    """Packs in; out: shard, n, size and blob of those of their sequences whose slots are in [low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, count, size, blob in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4), strict=True):
                raw = pa.decompress(blob.as_buffer(), decompressed_size=size, codec="zstd", asbytes=True)
                a, b, c = 8 * count, 12 * count, 14 * count
                ids, nth, sizes = np.frombuffer(raw[:a], np.int64), np.frombuffer(raw[a:b], np.int32), np.frombuffer(raw[b:c], np.int16)
                last_byte = c + np.cumsum(sizes.astype(np.int64)) * kind.itemsize
                first_byte = last_byte - sizes.astype(np.int64) * kind.itemsize
                at = first[part] + before
                slot = permute(np.arange(at, at + count), n, key)
                order = np.argsort(slot)
                order = order[(slot[order] >= low) & (slot[order] < high)]
                if not len(order):
                    continue
                shard = slot[order] // per_shard
                edge = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                rows = []
                for i, j in zip(edge.tolist(), np.append(edge[1:], len(shard)).tolist(), strict=True):
                    own = order[i:j]
                    heads = (slot[own], ids[own], nth[own], sizes[own])
                    out = b"".join([*(x.tobytes() for x in heads), *(raw[x:y] for x, y in zip(first_byte[own].tolist(), last_byte[own].tolist(), strict=True))])
                    rows.append((int(shard[i]), j - i, len(out), pa.compress(out, codec="zstd", asbytes=True)))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["shard", "n", "size", "blob"])

    return run


def _records(length: int, kind: np.dtype, pad: int):
    """Columns in, sorted by shard: shard, n, size, blob. Out: shard and its records in slot order."""
    stride = stride_of(length, kind)

    def emit(shard: int, parts: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        slots, heads, lengths, bodies = [], [], [], []
        for n, raw in parts:
            ends = np.cumsum([8 * n, 8 * n, 4 * n, 2 * n])
            slots.append(np.frombuffer(raw[: ends[0]], np.int64))
            head = np.zeros((n, HEAD), np.uint8)
            for a, b, lo, hi in ((ends[0], ends[1], 0, 8), (ends[1], ends[2], 8, 12), (ends[2], ends[3], 12, 14)):
                head[:, lo:hi] = np.frombuffer(raw[a:b], np.uint8).reshape(n, hi - lo)
            heads.append(head)
            lengths.append(np.frombuffer(raw[ends[2] : ends[3]], np.int16).astype(np.int64))
            bodies.append(np.frombuffer(raw[ends[3] :], kind))
        slot, head, size, body = (np.concatenate(x) for x in (slots, heads, lengths, bodies))
        table = np.full((len(slot), length), pad, kind)
        table[np.arange(length) < size[:, None]] = body
        out = np.zeros((len(slot), stride - 1), np.uint8)
        out[:, :HEAD] = head
        out[:, HEAD : HEAD + length * kind.itemsize] = table.view(np.uint8).reshape(len(slot), -1)
        out = out[np.argsort(slot)]
        at = np.arange(len(slot) + 1, dtype=np.int32) * (stride - 1)
        records = pa.BinaryArray.from_buffers(pa.binary(), len(slot), [None, pa.py_buffer(at), pa.py_buffer(out)])
        for a in range(0, len(slot), 4096):
            own = records[a : a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(own), pa.int32()), own], ["shard", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:
            for own, n, size, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if own != shard and parts:
                    yield from emit(shard, parts)
                    parts = []
                shard = own
                parts.append((n, pa.decompress(blob.as_buffer(), decompressed_size=size, codec="zstd", asbytes=True)))
        if parts:
            yield from emit(shard, parts)

    return run


def write_sequences(
    docs: DataFrame, folder: str, path: str, length: int = SEQUENCE, key: int = KEY, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> dict:
    """Write all sequences to ``folder`` in their global order; returns what a reader must know."""
    end = encoder(path)[1]
    kind = _kind(end)
    stride = stride_of(length, kind)
    per_shard = max(1, shard_bytes // stride)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if exists(docs.sparkSession, folder):
        raise FileExistsError(folder)
    packs = stored(source.mapInArrow(lean(_packs(path, length)), _PACK), "tokens")
    counts = dict(packs.groupBy("part").agg(F.sum("n")).collect())  # a number for each partition
    first, n = {}, 0
    for part in sorted(counts):
        first[part], n = n, n + counts[part]
    layout = {"folder": folder, "sequences": n, "length": length, "stride": stride, "per_shard": per_shard, "ids": kind.str, "end": end}
    shards = -(-n // per_shard)
    step = -(-shards // PASSES)
    for low in range(0, shards, step or 1):
        own = min(step, shards - low)
        deal = _deal(first, n, key, per_shard, low * per_shard, (low + own) * per_shard, kind)
        dealt = packs.mapInArrow(lean(deal), "shard int, n int, size long, blob binary")
        tasks = min(own, max(partitions(docs.sparkSession), 1))
        # Neighbouring shards to one task, which writes them one after another.
        sent = dealt.repartitionById(tasks, F.floor((F.col("shard") - low) * tasks / own).cast("int")).sortWithinPartitions("shard")
        records = sent.mapInArrow(lean(_records(length, kind, end)), "shard int, record binary")
        with _files_dropped_after(docs.sparkSession):
            records.select("shard", F.col("record").cast("string").alias("record")).write.mode("append").partitionBy("shard").option("lineSep", "\n").text(folder)
    return layout


@contextmanager
def _files_dropped_after(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _listed(layout: dict):
    stride, per_shard, length, kind = layout["stride"], layout["per_shard"], layout["length"], np.dtype(layout["ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = np.frombuffer(content.as_buffer(), np.uint8)
                if len(raw) % stride or not (raw[stride - 1 :: stride] == 10).all():
                    raise RuntimeError(f"shard {shard} is damaged")
                table = raw.reshape(-1, stride)
                ids = np.ascontiguousarray(table[:, :8]).view("<i8").ravel()
                nth, size = np.ascontiguousarray(table[:, 8:12]).view("<i4").ravel(), np.ascontiguousarray(table[:, 12:14]).view("<i2").ravel()
                digests = [xxhash.xxh64_intdigest(r[HEAD : HEAD + n * kind.itemsize].tobytes()) - (1 << 63) for r, n in zip(table, size.tolist(), strict=True)]
                place = np.arange(len(table))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=ids == NO_ID),
                        pa.array(nth, pa.int32()),
                        pa.array(shard * per_shard + place, pa.int64()),
                        pa.array([shard] * len(table), pa.int32()),
                        pa.array(place * stride, pa.int64()),
                        pa.array(size.astype(np.int32), pa.int32()),
                        pa.array(digests, pa.int64()),
                    ],
                    ["doc_id", "sequence", "slot", "shard", "byte", "n_tokens", "ids_hash"],
                )

    return run


LISTED = "doc_id long, sequence int, slot long, shard int, byte long, n_tokens int, ids_hash long"


def list_sequences(spark: SparkSession, layout: dict) -> DataFrame:
    """What the written shards hold, read back from them: a row for each record, with its place."""
    if not layout["sequences"]:
        return spark.createDataFrame([], LISTED)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(layout["folder"])
    return files.select(F.col("shard").cast("int").alias("shard"), "content").mapInArrow(lean(_listed(layout)), LISTED)


def read_sequences(spark: SparkSession, layout: dict, start: int = 0) -> Iterator[tuple[int, list[int]]]:
    """(doc_id, ids) from slot ``start`` on, shard after shard; only bytes that are asked for are read."""
    kind, stride, per_shard = np.dtype(layout["ids"]), layout["stride"], layout["per_shard"]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for shard in range(start // per_shard, -(-layout["sequences"] // per_shard)):
        folder = jvm.org.apache.hadoop.fs.Path(f"{layout['folder']}/shard={shard}")
        fs = folder.getFileSystem(conf)
        file = next(s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
        at, stream = max(0, start - shard * per_shard) * stride, fs.open(file.getPath())
        try:
            stream.seek(at)
            while at < file.getLen():
                raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, stride))
                size = int.from_bytes(raw[12:14], "little")
                yield int.from_bytes(raw[:8], "little", signed=True), np.frombuffer(raw[HEAD : HEAD + size * kind.itemsize], kind).tolist()
                at += stride
        finally:
            stream.close()


def materialise(docs: DataFrame, path: str, folder: str | None = None, **options) -> DataFrame:
    """Write the shards (by default to the shared work folder) and list them."""
    spark = docs.sparkSession
    return list_sequences(spark, write_sequences(docs, folder or f"{work_folder(spark, 'sequences')}/shards", path, **options))
