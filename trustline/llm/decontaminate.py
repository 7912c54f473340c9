"""Benchmark decontamination with training suffix arrays.

Each slice of the training documents is a shard.  Its suffix array holds the word positions
at which a test window could start, sorted by what follows; every test suffix is searched in
it by bisection, which yields the locations of all windows that occur and the longest verbatim
match at each.  Nothing is shuffled: the benchmark goes to the shards in blocks of bounded
size, one pass over the documents for each block.

Defined cases: a NULL or empty text has no words, so it is never hit; an item with fewer words
than a window is one window, an item without words none.  Items with equal ids count once,
items without id count as one whose id prints as the empty string.  Repeated documents are
judged alike, an empty table gives an empty one, and other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustline.llm.shared import lean
from trustline.llm.words import ALPHANUMERIC_FOLDED, slices

WINDOW = 13
BLOCK_BYTES = 32 << 20  # of benchmark text sent to the shards at once
SHARD_BYTES = 4 << 20  # of training text in one suffix array

_MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("item_word", T.IntegerType()),
            T.StructField("word", T.IntegerType()),
            T.StructField("words", T.IntegerType()),
        ]
    )
)
_ARROW_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("words", pa.int32())]))
#: Of one document: its words, those hit, and the longest verbatim matches.
REPORT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("matches", _MATCH)])


class Suffixes:
    """The suffixes of a block of test items, ready for search in training suffix arrays."""

    def __init__(self, ids: list[str], texts: list[str], window: int) -> None:
        self.ids, self.window = ids, window
        words, sizes = [np.empty(0, np.uint64)], []
        for part in slices(pa.array(texts, pa.large_string()), ALPHANUMERIC_FOLDED):
            words.append(part.hashes)
            sizes.extend(np.diff(part.word_at).tolist())
        flat, length = np.concatenate(words), np.array(sizes, np.int64)
        self.first = np.cumsum(length) - length
        self.vocabulary = np.unique(flat)
        self.item = np.repeat(np.arange(len(length)), length)
        self.left = np.repeat(self.first + length, length) - np.arange(len(flat))
        self.need = np.minimum(length, window)[self.item]
        self.code = np.zeros(len(flat) + max(window, int(length.max(initial=0))) + 1, np.int64)
        self.code[: len(flat)] = np.searchsorted(self.vocabulary, flat) + 1
        self.start = np.flatnonzero(self.left >= self.need)  # where windows start
        # A training suffix that holds a window starts like one, for this many words.
        self.head = int(self.need.min(initial=3))
        self.heads = np.unique(self._head(self.code, self.start))
        self.low = self._keys(self.code, self.start, self.need[self.start], 0)
        self.high = self._keys(self.code, self.start, self.need[self.start], 0xFF)

    def _head(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for j in range(self.head):
            out = out * (len(self.vocabulary) + 1) + code[at + j]
        return out

    def _keys(self, code: np.ndarray, at: np.ndarray, need: np.ndarray | None = None, fill: int = 0) -> np.ndarray:
        """Byte strings that sort like the words from ``at`` on; beyond ``need`` words all bytes are ``fill``."""
        width = 4 * self.window + 1  # the last byte is not 0, as numpy drops zeros at the end
        raw = np.ones((len(at), width), np.uint8)
        raw[:, :-1] = code[at[:, None] + np.arange(self.window)].astype(">u4").view(np.uint8).reshape(len(at), width - 1)
        if need is not None:
            raw[np.arange(width) >= 4 * need[:, None]] = fill
        return raw.view(f"S{width}").ravel()

    def search(self, words: np.ndarray, word_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(test suffix, training word, words of the longest match) wherever a window occurs in this shard."""
        none = (np.empty(0, np.int64),) * 3
        if not len(words) or not len(self.start):
            return none
        place = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        at = np.arange(len(words)) + np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))
        # Between texts stands 0, which no test item has; so do words that are in no item.
        code = np.zeros(int(at[-1]) + len(self.code) + 1, np.int64)
        code[at] = np.where(self.vocabulary[place] == words, place + 1, 0)
        able = at
        for j in range(self.head):
            able = able[code[able + j] > 0]
        able = able[np.isin(self._head(code, able), self.heads)]
        keys = self._keys(code, able)
        order = np.argsort(keys, kind="stable")
        array, keys = able[order], keys[order]  # the shard's suffix array
        low, high = np.searchsorted(keys, self.low), np.searchsorted(keys, self.high, side="right")
        hits = high - low
        which = np.repeat(np.arange(len(hits)), hits)
        found = array[np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)]
        suffix = self.start[which]
        length = self.need[suffix].copy()
        live = np.arange(len(found))
        while len(live):  # as far as the match is verbatim
            n = length[live]
            live = live[(n < self.left[suffix[live]]) & (code[found[live] + n] == self.code[suffix[live] + n])]
            length[live] += 1
        return suffix, np.searchsorted(at, found), length

    def longest(self, suffix: np.ndarray, word: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Indices of the matches that are not the rest of one that starts earlier."""
        item, lead, end = self.item[suffix], word - suffix, word + length
        order = np.lexsort((word, lead, item))
        item, lead, end = item[order], lead[order], end[order]
        keep = np.ones(len(order), bool)
        keep[1:] = (item[1:] != item[:-1]) | (lead[1:] != lead[:-1]) | (end[1:] != end[:-1])
        return order[keep]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple[list[str], list[str]]]:
    """The items in blocks of at most ``limit`` characters (a longer item is alone), read a partition at a time."""
    ids, texts, size = [], [], 0
    frame = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    for item, text in frame.toLocalIterator():
        if size and size + len(text) > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(item)
        texts.append(text)
        size += len(text)
    yield ids, texts


def _pass(tests: Suffixes, text_at: int, prior_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, found = [], [], []
            prior = batch.column(prior_at).field("matches").to_pylist()
            for part in slices(batch.column(text_at), ALPHANUMERIC_FOLDED, SHARD_BYTES):
                suffix, word, length = tests.search(part.hashes, part.word_at)
                best = tests.longest(suffix, word, length)
                suffix, word, length = suffix[best], word[best], length[best]
                row = np.searchsorted(part.word_at, word, side="right") - 1
                own: dict[int, list[dict]] = {r: list(x) for r, x in enumerate(prior[part.first : part.first + part.count]) if x}
                for r, s, w, n in zip(row.tolist(), suffix.tolist(), (word - part.word_at[row]).tolist(), length.tolist(), strict=True):
                    item = int(tests.item[s])
                    own.setdefault(r, []).append({"item_id": tests.ids[item], "item_word": s - int(tests.first[item]), "word": w, "words": n})
                edge = np.zeros(len(part.hashes) + 1, np.int64)
                for r, matches in own.items():
                    at = int(part.word_at[r])
                    for m in matches:
                        edge[at + m["word"]] += 1
                        edge[at + m["word"] + m["words"]] -= 1
                hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
                n_words.extend(np.diff(part.word_at).tolist())
                n_hit.extend((hit[part.word_at[1:]] - hit[part.word_at[:-1]]).tolist())
                found.extend(own.get(r, []) for r in range(part.count))
            report = pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, _ARROW_MATCH)], ["n_words", "n_hit", "matches"]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:prior_at], report], schema.names)

    return run


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str] | None = None,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` columns of the documents (default: all) as k0, k1, ... and ``report``: words, words hit, longest matches."""
    keep = docs.columns if keep is None else keep
    n = len(keep)
    empty = F.struct(F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast(_MATCH).alias("matches"))
    out = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("text"), empty.alias("report"))
    schema = out.schema
    for ids, texts in _blocks(benchmark, item_id_col, item_text_col, block):
        tests = Suffixes(ids, texts, window)
        names = pa.schema([(name, pa.null()) for name in schema.names])
        out = out.mapInArrow(lean(_pass(tests, n, n + 1, names)), schema)
    return out.drop("text")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty lies in an occurrence of a window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that aren't contaminated, whole and with all their columns."""
    found = find_benchmark(docs, benchmark, text_col=text_col, **options)
    clean = found.where(~contaminated(F.col("report.n_hit"), F.col("report.n_words")))
    return clean.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
