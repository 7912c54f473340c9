"""Packing token sequences by bounded-space online best fit.

Each text is encoded, closed with an end id and, where it is longer than a sequence, cut into
pieces of a whole sequence each; the last piece may be shorter.  A packer takes pieces as they
come and keeps a fixed number of bins open, listed by their free space, with a bitset that
says which amounts of free space there are.  A piece goes to the bin with the least free space
that holds it (one shift and the lowest set bit); where none does, a new bin is opened, and if
that would be one too many, the fullest is closed first.  A full bin closes by itself.

Pieces that fill a sequence are not packed at all.  The rest are numbered once, when they are
stored, and dealt by a hash of their number, so that each packer gets about PACKER pieces in
batches of about BATCH, whatever ids, texts or copies there are; in a batch long ones come
first, which leaves the short ones to fill the gaps.  A packer that is run again gets the same
pieces in the same order.  Only lengths are needed for that; the ids travel with the pieces
where they are asked for.

ASCII white space never reaches the merges and no normal form joins it with a neighbour, so a
text's ids are those of its words.  Stretches of words of ASCII and Latin letters are lower-cased
and split by the tokenizer file's own pattern, and their parts go to the library's model; every
other word goes to the library as it is.  A worker keeps the ids of parts it has seen.  That
holds for files with the normalizer and splitter that ``Words`` names; with another file whole
texts go to the library.

Defined cases: a NULL or empty text is one piece that holds the end id alone; a NULL id stays
NULL; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trustline.llm.shared import lean, stored
from trustline.llm.tokens import byte_letters

SEQUENCE = 2048
END = 0
OPEN_BINS = 1024
PACKER = 1 << 16  # pieces that one packer gets, give or take chance
BATCH = 1 << 11  # pieces that arrive together, likewise
LONG = 1 << 20  # bytes split into words at once
BATCH_BYTES = 4 << 20  # of ids handed on at once
HELD = 500_000  # parts of words, and odd words, whose ids a worker keeps

# The parts of a tokenizer file for which a text's ids are those of its words.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Latin letters that are their own normal form and whose lower case is one letter.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_ODD = re.compile(f"[^\x20-\x7e{LATIN}]").finditer
_PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[a-z{LATIN}]+|[0-9]|[^ a-z0-9{LATIN}]+").findall
_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_CUT = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """Read once by each worker, which has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def _ids(found: list[int]) -> bytes:
    return pack_ids(f"<{len(found)}I", *found)


class Held(dict):
    """Results of ``find``, kept until there are too many."""

    def __init__(self, find: Callable[[str], bytes]) -> None:
        self.find = find

    def __missing__(self, key: str) -> bytes:
        if len(self) >= HELD:
            self.clear()
        known = self[key] = self.find(key)
        return known


class Words:
    """The ids of words between ASCII white space, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        own = tokenizer(path)
        self.encode, self.model = own.encode, own.model.tokenize
        self.letters = {b: c for c, b in byte_letters().items()}
        special = [t["content"] for t in spec["added_tokens"]]
        self.at_special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search
        splitter = (spec["pre_tokenizer"] or {}).get("pretokenizers")
        # Special strings are looked for before a text is split, so they must not span words.
        self.splits = spec["normalizer"] == NORMALIZER and splitter == SPLITTER and spec["post_processor"] is None and not any(re.search(r"\s", t) for t in special)
        self.parts, self.odd = Held(self._part), Held(self.whole)

    def _part(self, part: str) -> bytes:
        return _ids([t.id for t in self.model(part if part.isascii() else part.encode().decode("latin-1").translate(self.letters))])

    def whole(self, text: str) -> bytes:
        return _ids(self.encode(text, add_special_tokens=False).ids)

    def _plain(self, stretch: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, _PARTS(stretch.lower())))

    def ids(self, raw: bytes) -> bytes:
        """The ids of a text that is split word by word."""
        text = raw.translate(_SPACES).decode()
        if self.at_special(text):
            return b"".join(map(self.odd.__getitem__, text.split(" ")))
        out, at = [], 0
        for found in _ODD(text):
            i = found.start()
            if i >= at:
                begin, end = max(at, text.rfind(" ", at, i) + 1), text.find(" ", i)
                end = end if end >= 0 else len(text)
                out += (self._plain(text[at:begin]), self.odd[text[begin:end]])
                at = end
        out.append(self._plain(text[at:]))
        return b"".join(out)


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def parts(raw: bytes, long: int = LONG) -> Iterator[bytes]:
    """A text in parts of at least ``long`` bytes that end before ASCII white space."""
    at = 0
    while at < len(raw):
        cut = _CUT.search(raw, at + long)
        to = cut.start() if cut else len(raw)
        yield raw[at:to]
        at = to


def token_ids(path: str, raw: bytes, long: int = LONG) -> bytes:
    """The ids of a UTF-8 text, as little-endian unsigned 32-bit integers."""
    known = words(path)
    if not known.splits:
        return known.whole(raw.decode())
    return b"".join(map(known.ids, parts(raw, long)))


def _cut(path: str, size: int, end: int, keep_ids: bool):
    """Columns in: id, text. Out: a row for each piece."""

    last = _ids([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            found, held = [], 0

            def told() -> pa.RecordBatch:
                nonlocal at
                row, piece, start, length, crc, ids = zip(*found, strict=True)
                columns = {
                    "at": pa.array(np.arange(at, at + len(row)), pa.int64()),
                    "id": batch.column(0).take(pa.array(row, pa.int64())),  # noqa: B023
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                at += len(row)
                return pa.RecordBatch.from_pydict(columns)

            for row, text in enumerate(batch.column(1).cast(pa.binary())):
                raw = token_ids(path, text.as_py() or b"") + last
                for k, begin in enumerate(range(0, len(raw), 4 * size)):
                    part = raw[begin : begin + 4 * size]
                    found.append((row, k, begin // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
                held += len(raw)
                if held > BATCH_BYTES:
                    yield told()
                    found, held = [], 0
            if found:
                yield told()

    return run


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, end: int = END, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: at (a number of its own), id, piece, start, length, ids_crc32 and, if asked for, ids of each piece."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"at long, id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return stored(source.mapInArrow(lean(_cut(path, size, end, keep_ids)), schema), "pieces")


class Packer:
    """A fixed number of open bins, found by their free space."""

    def __init__(self, size: int, open_bins: int) -> None:
        self.size, self.most = size, open_bins
        self.free = 0  # bit f is set where an open bin has f free places
        self.bins: dict[int, list[int]] = {}
        self.opened = self.n_open = 0

    def _take(self, free: int) -> int:
        own = self.bins[free]
        taken = own.pop()
        if not own:
            del self.bins[free]
            self.free ^= 1 << free
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) of the next piece."""
        fitting = self.free >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            into = self._take(free)
        else:
            if self.n_open == self.most:
                self._take((self.free & -self.free).bit_length() - 1)
                self.n_open -= 1
            free, into = self.size, self.opened
            self.opened += 1
            self.n_open += 1
        left = free - length
        if left:
            if left not in self.bins:
                self.bins[left] = []
                self.free |= 1 << left
            self.bins[left].append(into)
        else:
            self.n_open -= 1
        return into, self.size - free


def _pack(size: int, open_bins: int):
    """Columns in, sorted by packer and arrival: packer, length, and others. Out: these, sequence_id and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bins = None, None
        for batch in batches:
            names = batch.schema.names
            sequence, offset = [], []
            for own, length in zip(batch.column(names.index("packer")).to_pylist(), batch.column(names.index("length")).to_pylist(), strict=True):
                if own != packer:
                    packer, bins = own, Packer(size, open_bins)
                into, place = bins.place(length)
                sequence.append((own << 40) + into)
                offset.append(place)
            rest = [c for c in names if c not in ("packer", "batch")]
            columns = [*(batch.column(names.index(c)) for c in rest), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "sequence_id", "offset"])

    return run


def pack(found: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, packer: int = PACKER) -> DataFrame:
    """Stored ``pieces`` with their sequence_id and offset."""
    whole = found.where(F.col("length") == size).select(*found.columns, (-1 - F.col("at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.where(F.col("length") < size)
    n = rest.count()
    packers = max(1, -(-n // packer))
    batches = max(1, -(-n // (packers * BATCH)))
    dealt = rest.withColumns({"packer": F.pmod(F.xxhash64("at"), F.lit(packers)), "batch": F.pmod(F.xxhash64("at", F.lit(1)), F.lit(batches))})
    schema = rest.schema.add("sequence_id", "long").add("offset", "long")
    sorted_ = dealt.repartitionById(packers, F.col("packer").cast("int")).sortWithinPartitions("packer", "batch", F.desc("length"), "at")
    return whole.unionByName(sorted_.mapInArrow(_pack(size, open_bins), schema))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, its ids (little-endian unsigned 32 bits) and its parts in order, from packed pieces with their ids."""
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "id", "piece", "ids"))).alias("own"))
    joined = F.aggregate("own.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return own.select("sequence_id", joined.alias("ids"), F.transform("own", lambda p: p.dropFields("ids")).alias("parts"))


def pack_documents(docs: DataFrame, path: str, size: int = SEQUENCE, open_bins: int = OPEN_BINS, packer: int = PACKER, **columns) -> DataFrame:
    """Encode, cut and pack: id, piece, start, length, ids_crc32, sequence_id, offset and, with ``keep_ids``, ids."""
    return pack(pieces(docs, path, size, **columns), size, open_bins, packer).drop("at")
