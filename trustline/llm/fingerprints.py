"""Document fingerprints by winnowing.

Hashes of all runs of GRAM characters are rolled over the text; of every WINDOW consecutive
ones the smallest is chosen, the rightmost of equal ones.  A passage of GRAM + WINDOW - 1
characters that two texts share puts at least one common hash into both fingerprints, and the
kept positions say where.  Long texts are winnowed in pieces that overlap by a window, so the
memory for hashes doesn't grow with the text.

Defined cases: a NULL text counts as empty and has an empty fingerprint; a text shorter than
a run is hashed whole; two empty fingerprints are alike (1.0), an empty one is unlike any
other (0.0).  A NULL id comes before all ids; rows with equal ids come in the order of their
texts' hashes, also where a third of all rows has one id or none.  With one row in all, its next document is itself.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.llm.shared import partitions, place
from trustline.llm.words import _POWERS, mix

GRAM, WINDOW = 16, 32  # a shared passage of 47 characters is always found
PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions in characters) of a text's fingerprint, by position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    gram = min(gram, n)
    window = min(window, n - gram + 1)
    hashes, places = [], []
    for start in range(0, n - gram - window + 2, PIECE):
        own = codes[start : start + PIECE + window + gram - 2]
        up, down = _POWERS.upto(len(own) + 1)
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(mix(own.astype(np.uint64) + np.uint64(1)) * up[: len(own)], out=total[1:])
        key = mix((total[gram:] - total[:-gram]) * down[: len(total) - gram])
        # The place counts backwards in the low bits, so the rightmost of equal hashes is the smallest key.
        key = (key & ~_PLACE) | (_PLACE - np.arange(len(key), dtype=np.uint64))
        span, least = 1, key
        while span * 2 <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[: len(key) - window + 1], least[window - span :])
        chosen = least[np.append(True, least[1:] != least[:-1])]
        hashes.append((chosen >> np.uint64(32)).astype(np.uint32))
        places.append((_PLACE - (chosen & _PLACE)).astype(np.int64) + start)
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    new = np.append(True, places[1:] != places[:-1])  # chosen at the end of a piece and again in the next
    return hashes[new], places[new]


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' hashes."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    one, other = np.unique(one), np.unique(other)
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / (len(one) + len(other) - both)


def printed(hashes: np.ndarray) -> str:
    """Eight hexadecimal digits for each hash, in the order of the text."""
    return hashes.astype(">u4").tobytes().hex()


def _fingerprints(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            found = [winnow(t, gram, window) for t in texts]
            columns = [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                pa.array([p for _, p in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "hashes", "positions"])

    return run


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Per document: id, n_chars, and the hashes of its fingerprint with their positions."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_fingerprints(gram, window), f"id {kind}, n_chars long, hashes array<long>, positions array<long>")


FINER = 4
_LOWEST = int(np.iinfo(np.int64).min)
_PLACED = ["order", "tie", "spread"]


def _even(m: int) -> list[float]:
    return [j / m for j in range(1, m)]


def _cuts(rows: DataFrame, n: int) -> list[dict[str, int]]:
    """Where the n shares begin, at most n - 1 places in (order, tie, spread).

    An id that takes several shares is cut by its ties, a tie that takes several by spread, so
    neither rows without an id nor rows alike meet in one share.
    """
    ids = Counter(rows.agg(F.percentile_approx("order", _even(n), 10_000)).first()[0] or []) if n > 1 else Counter()
    ties: dict[int, Counter] = {}
    if max(ids.values(), default=0) > 1:
        most = max(ids.values())
        hot = rows.where(F.col("order").isin([i for i, m in ids.items() if m > 1]))
        found = hot.groupBy("order").agg(F.percentile_approx("tie", _even(most), 10_000).alias("ties")).collect()
        ties = {r.order: Counter(r.ties[round(j * most / ids[r.order]) - 1] for j in range(1, ids[r.order])) for r in found}
    cuts = {(i, _LOWEST, _LOWEST) for i in ids}
    for i, shares in ties.items():
        for tie, m in shares.items():
            cuts |= {(i, tie, _LOWEST + (j << 64) // m) for j in range(m)}
    return [dict(zip(_PLACED, c, strict=True)) for c in sorted(cuts)]


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows dealt by ranges of (id, text hash), sorted; each partition ends with a copy of the row that follows its last one.

    Columns: id, text, copy, order, tie.  Texts are shuffled once.  ``docs`` is read more than
    once, so it should be stored.
    """
    n = partitions(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    # Different for all rows, and in no order.
    spread = F.xxhash64(F.monotonically_increasing_id())
    rows = rows.withColumns({"order": F.coalesce("id", F.lit(_LOWEST)), "tie": F.xxhash64("text"), "spread": spread})
    # A cut beside a common id leaves up to two shares together, so the shares are finer than the partitions.
    share = place(F.struct(*_PLACED), _cuts(rows, FINER * n), "struct<" + ",".join(f"{c}:bigint" for c in _PLACED) + ">")
    rows = rows.withColumn("part", F.floor(share / FINER).cast("int"))
    # The first row of each partition, as many as there are partitions.
    first = {r.part: r.first for r in rows.groupBy("part").agg(F.min(F.struct("order", "tie")).alias("first")).collect()}
    used = sorted(first)
    follows = [(*first[b], a) for a, b in zip(used, used[1:] + used[:1], strict=True)]
    ahead = docs.sparkSession.createDataFrame(follows, "order long, tie long, ahead int")
    # Rows alike in both have the same text, and any of them will do.
    copies = rows.join(F.broadcast(ahead), ["order", "tie"]).groupBy("ahead").agg(F.first(F.struct("id", "text", "order", "tie")).alias("row"))
    copies = copies.select("row.*", F.lit(True).alias("copy"), F.col("ahead").alias("part"))
    columns = ["id", "text", "copy", "order", "tie", "part"]
    rows = rows.withColumn("copy", F.lit(False)).select(*columns).unionByName(copies.select(*columns))
    return rows.repartitionById(max(n, 1), "part").sortWithinPartitions("copy", "order", "tie").drop("part")


def _edits(gram: int, window: int):
    """Columns in, sorted: id, text, copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for ident, text, copy in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if copy and held is None:
                    break  # only the first copy follows the last row
                hashes, _ = winnow(text, gram, window)
                if held is not None:
                    own, before, mine = held
                    cut = len(before) // 4
                    edited = before[: len(before) - cut] + text[:cut]
                    theirs, _ = winnow(edited, gram, window)
                    out.append(
                        (own, len(before), hashlib.sha256(edited.encode()).hexdigest(), printed(mine), printed(theirs), likeness(mine, theirs), likeness(mine, hashes))
                    )
                held = None if copy else (ident, text, hashes)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint beside that of its text with the last quarter from the next document, and the likenesses."""
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, id_col, text_col).select("id", "text", "copy").mapInArrow(_edits(gram, window), schema)
