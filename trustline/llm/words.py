"""Words of whole texts, found and hashed in numpy straight from Arrow buffers.

A text is a run of UTF-8 bytes; which bytes belong to words is a table of 256 flags, so no
Python string is made per word.  A word's hash is a polynomial over random values of its
bytes, modulo 2**64, then mixed; equal words have equal hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes scanned at once
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


@dataclass(frozen=True)
class Alphabet:
    """Which bytes make words, and the value that each byte counts as."""

    member: np.ndarray
    value: np.ndarray


def alphabet(member: np.ndarray, fold_case: bool) -> Alphabet:
    code = np.arange(256)
    if fold_case:
        code = np.where((code >= 65) & (code <= 90), code + 32, code)
    return Alphabet(member, mix(code.astype(np.uint64) + np.uint64(1)))


def _not_space() -> np.ndarray:
    member = np.ones(256, bool)
    member[[0x20, *range(0x09, 0x0E)]] = False
    return member


def _alphanumeric() -> np.ndarray:
    code = np.arange(256)
    return (code >= 0x80) | ((code >= 48) & (code <= 57)) | ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122))


#: ``[^\x20\x09-\x0D]+`` as written, the same with A-Z lowered, and letters and digits with A-Z lowered.
SPACED = alphabet(_not_space(), fold_case=False)
SPACED_FOLDED = alphabet(_not_space(), fold_case=True)
ALPHANUMERIC_FOLDED = alphabet(_alphanumeric(), fold_case=True)


class _Powers:
    """Powers of the base and of its inverse, as far as any chunk has needed them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            step = np.full(n, _BASE, np.uint64)
            step[0] = 1
            back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            back[0] = 1
            self.up, self.down = np.cumprod(step), np.cumprod(back)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _chunk(raw: np.ndarray, breaks: np.ndarray, letters: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = letters.member[raw]
    n = len(raw)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    before[breaks[breaks < n]] = False
    after[breaks[(breaks > 0) & (breaks <= n)] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _POWERS.upto(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(letters.value[raw] * up, out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def scan(raw: np.ndarray, breaks: np.ndarray, letters: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words in ``raw``; ``breaks`` are the sorted offsets of the texts.

    Long inputs are scanned in chunks cut between words, so memory beyond the words
    themselves doesn't grow with a text, unless a single word is longer than a chunk.
    """
    found, at, n = [], 0, len(raw)
    while at < n:
        to = min(n, at + CHUNK)
        while to < n:
            gaps = np.flatnonzero(~letters.member[raw[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            to = min(n, to + CHUNK)
        low, high = np.searchsorted(breaks, (at, to))
        starts, ends, hashes = _chunk(raw[at:to], breaks[low : high + 1] - at, letters)
        found.append((starts + at, ends + at, hashes))
        at = to
    if not found:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@dataclass
class Slice:
    """Some consecutive rows of a batch with the words of their texts."""

    first: int  # row of the batch
    count: int
    raw: np.ndarray
    text_at: np.ndarray  # count + 1 byte offsets
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    word_at: np.ndarray  # count + 1 offsets into starts

    @property
    def row_of(self) -> np.ndarray:
        """Row within the slice, for each word."""
        return np.repeat(np.arange(self.count), np.diff(self.word_at))

    def words(self, row: int) -> list[bytes]:
        view = self.raw.tobytes() if self.count == 1 else self.raw[self.text_at[row] : self.text_at[row + 1]].tobytes()
        shift = 0 if self.count == 1 else int(self.text_at[row])
        low, high = self.word_at[row], self.word_at[row + 1]
        return [view[a - shift : b - shift] for a, b in zip(self.starts[low:high].tolist(), self.ends[low:high].tolist(), strict=True)]


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as the empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(column: pa.Array, letters: Alphabet, limit: int = CHUNK) -> Iterator[Slice]:
    """Cut a batch into runs of rows of about ``limit`` bytes (a longer text is alone) and find their words."""
    raw, at = raw_texts(column)
    row, n = 0, len(column)
    while row < n:
        to = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        to = min(to, n)
        own = raw[at[row] : at[to]]
        text_at = at[row : to + 1] - at[row]
        starts, ends, hashes = scan(own, text_at, letters)
        yield Slice(row, to - row, own, text_at, starts, ends, hashes, np.searchsorted(starts, text_at))
        row = to


_SHINGLE = 0xD1342543DE82EF95


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words, by its first word; runs over text ends are included."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(_SHINGLE)
        out += hashes[j : j + n]
    return mix(out)


def whole(word_at: np.ndarray, n: int, k: int) -> np.ndarray:
    """Flags of the runs of k words that lie within one text; ``n`` words in all."""
    size = max(0, n - k + 1)
    ok = np.ones(size, bool)
    for j in range(1, k):
        cut = word_at[1:-1] - j
        ok[cut[(cut >= 0) & (cut < size)]] = False
    return ok
