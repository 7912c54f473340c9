"""Token counts by prefix dynamic programming.

The pre-splitter cuts a text into pieces, and byte-pair encoding works within pieces.  For a
piece, the encoding of each prefix ends in exactly one token t such that the encoding of what
comes before t is followed by t without the two ever merging; so going through the prefixes
by length, each count is the count of a shorter prefix plus one, and the last token of every
prefix is enough to go on.  A piece's counts are kept, and pieces recur, so a text costs a
look-up for each piece.

The counts of all prefixes are stored as one signed byte per byte of text, the change of the
count, and everything else is answered from them: ``count_within`` and ``longest_within`` say how
many tokens a cut text has and how much text a budget holds, without encoding anything again.  (A
prefix is counted piece by piece, as the whole text is split.)  Within a character the count is
raised by MIDWAY, so no answer ends there.

Defined cases: a NULL text counts as empty and has no tokens; special tokens' strings inside
a text are one token each, as the tokenizer's default has it; other columns stay out.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.llm.shared import lean, stored
from trustline.llm.words import raw_texts

# Fixed value: the published pre-split pattern of this family of byte-level vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
HELD_PIECES, HELD_PAIRS = 400_000, 400_000  # look-ups a worker keeps
START = 6  # bytes by which pieces share what is known of their beginnings
_BYTE = (-1, b"", b"")
MIDWAY = 100  # more than the tokens of a character


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files: itself, or one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Changes(dict):
    """The changes of pieces, found when first asked for."""

    def __init__(self, prefixes: Callable[[bytes], list[int]]) -> None:
        self.prefixes = prefixes

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= HELD_PIECES:
            self.clear()
        raw = piece.encode()
        count = self.prefixes(raw)
        if len(raw) > len(piece):
            count = [n + MIDWAY if raw[i : i + 1] and raw[i] & 0xC0 == 0x80 else n for i, n in enumerate(count)]
        known = self[piece] = bytes([(after - before) & 0xFF for before, after in zip(count, count[1:], strict=False)])
        return known


class Vocabulary:
    """Byte-pair merges of a tokenizer file, and counts of all prefixes by them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.special = [t["content"] for t in spec["added_tokens"]]
        skip = set(self.special)
        self.tokens = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in skip}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        #: The first merge that makes each token: its rank, and the two parts.
        self.made: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (a, b), i in self.rank.items():
            self.made.setdefault(a + b, (i, a, b))
        #: The longest token with these two last bytes; any other token is a single byte.
        self.ending: dict[bytes, int] = {}
        for token in self.tokens:
            if len(token) > self.ending.get(token[-2:], 1):
                self.ending[token[-2:]] = len(token)
        self.split = regex.compile(PIECES).findall
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._whole: dict[bytes, bool] = {}
        self._starts: dict[bytes, tuple[list[int], list[bytes]]] = {}
        self._changes = _Changes(self.prefixes)

    def merge(self, text: bytes) -> list[bytes]:
        """Byte-pair encoding as defined: the lowest-ranked pair first, from the left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.rank.get((a, b), len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens side by side stay as they are: the merges that made them are undone, last first.

        Had a pair across the border merged before the merge that is undone, it would have come first.
        """
        rank, made, limit = self.rank, self.made, len(self.rank)
        while True:
            if rank.get((a, b), limit) < limit:
                return False
            (of_a, _, right), (of_b, left, _) = made.get(a, _BYTE), made.get(b, _BYTE)
            if of_a > of_b:
                limit, a = of_a, right
            elif of_b >= 0:
                limit, b = of_b + 1, left
            else:
                return True

    def _stay_apart(self, a: bytes, b: bytes) -> bool:
        if len(self._pairs) >= HELD_PAIRS:
            self._pairs.clear()
        known = self._pairs[a, b] = self.apart(a, b)
        return known

    def _is_whole(self, token: bytes) -> bool:
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merge(token) == [token]
        return known

    def prefixes(self, piece: bytes) -> list[int]:
        """Token count of each prefix of a piece, from the empty one on."""
        if len(piece) <= START:
            return self._on(piece, [0], [b""])[0]
        # Pieces often begin alike.
        start = self._starts.get(piece[:START])
        if start is None:
            if len(self._starts) >= HELD_PIECES:
                self._starts.clear()
            start = self._starts[piece[:START]] = self._on(piece[:START], [0], [b""])
        return self._on(piece, *map(list, start))[0]

    def _on(self, piece: bytes, count: list[int], last: list[bytes]) -> tuple[list[int], list[bytes]]:
        """The count and the last token of each prefix, where those of the first prefixes are known."""
        tokens, ending, apart = self.tokens, self.ending, self._pairs
        for end in range(len(count), len(piece) + 1):
            # No token that ends like this is longer.
            most = ending.get(piece[end - 2 : end], 1)
            for begin in range(end - most if end > most else 0, end):
                token = piece[begin:end]
                if token not in tokens:
                    continue
                if begin:
                    before = last[begin]
                    fits = apart.get((before, token))
                    if fits is None:
                        fits = self._stay_apart(before, token)
                else:
                    fits = self._is_whole(token)
                if fits:
                    count.append(count[begin] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token for byte {piece[end - 1]}")
        return count, last

    def changes(self, text: str) -> bytes:
        """The change of the token count with each byte of the text, a signed byte each."""
        of_piece = self._changes.__getitem__
        if not self.at_special or not any(s in text for s in self.special):
            return b"".join(map(of_piece, self.split(text)))
        out = []
        for i, part in enumerate(self.at_special.split(text)):
            if i % 2:
                # Cut short it is ordinary text, as a whole it is one token.
                inside = np.frombuffer(b"".join(map(of_piece, self.split(part[:-1]))), np.int8)
                tail = len(part.encode()) - len(inside)
                out.append(inside.tobytes() + np.array([0] * (tail - 1) + [1 - int(inside.sum())], np.int8).tobytes())
            else:
                out += map(of_piece, self.split(part))
        return b"".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Read once by each worker."""
    return Vocabulary(path)


def count_within(changes: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes."""
    return int(np.frombuffer(changes, np.int8)[:n_bytes].sum(dtype=np.int64))


def longest_within(changes: bytes, budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens."""
    total = np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])
    return int(np.flatnonzero(total <= budget)[-1])


def _counts(path: str):
    """Columns in: id, text. Out: id, n_bytes and the changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            found = [vocab.changes(text.as_py() or "") for text in batch.column(1)]
            sizes = pa.array([len(c) for c in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(found, pa.binary())], ["id", "n_bytes", "changes"])

    return run


def _answered(budget: int):
    """Columns in: id, n_bytes, changes. Out: these, and the tokens of the whole text and the bytes that the budget holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = raw_texts(batch.column(2))
            tokens, fitting = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = raw[a:b]
                tokens.append(count_within(own, b - a))
                fitting.append(longest_within(own, budget) if tokens[-1] > budget else b - a)
            columns = [batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(fitting, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens", "fitting_bytes", "changes"])

    return run


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: id, n_bytes and the counts of all prefixes (``changes``) of each document."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return stored(source.mapInArrow(lean(_counts(path)), f"id {kind}, n_bytes long, changes binary"), "prefix-counts")


def within(counts: DataFrame, budget: int) -> DataFrame:
    """What the stored counts say: n_tokens of each whole text, and the bytes that ``budget`` tokens hold."""
    kind = counts.schema["id"].dataType.simpleString()
    return counts.mapInArrow(lean(_answered(budget)), f"id {kind}, n_bytes long, n_tokens long, fitting_bytes long, changes binary")


def count_tokens(docs: DataFrame, path: str, budget: int, **columns) -> DataFrame:
    """Per document: id, n_bytes, n_tokens, the bytes that ``budget`` tokens hold, and the counts of all prefixes."""
    return within(prefix_counts(docs, path, **columns), budget)
