"""Quality by ordinal regression on graded ratings.

A cumulative-link model: one score, the sum of weights shared by all grades, and an ordered
threshold below each grade but the lowest, P(grade >= k) = 1 / (1 + exp(threshold_k - score)).
It gives the expected grade and the tail probability that selects documents.

Features are hashed: which words a text has, and which share of its words have each kind of
punctuation, are in capitals, or repeat the word before.  Grades come from two ratings:
0 toxic, 1 poor, 2 good.  The model is fitted on at most SAMPLE labelled rows, those with the
lowest hash of their id; that bound is the only thing that doesn't grow with the input.
Scoring is one pass over whole texts.

Defined cases: a NULL or empty text has no features and gets the score 0; rows with a NULL
rating or id are not learnt from, and of several ratings of a document the lowest counts;
repeated documents get equal results.  If fewer than two grades are rated nothing can be
learnt: all documents have the highest grade and stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustline.llm.shared import lean, tidy
from trustline.llm.words import ALPHANUMERIC_FOLDED, Slice, alphabet, mix, scan, slices

SAMPLE = 8_000
BUCKET_BITS = 22
MIN_DOCS = 4  # of the sample that have a feature
STEPS = 250
RATE = 0.05
SPARSITY = 0.3
GRADES = 3
TAIL = 0.5
SCANNED = 1 << 18  # bytes of text whose features are held at once

_CODE = np.arange(256)
_PUNCTUATION = alphabet((_CODE > 0x20) & (_CODE < 0x7F) & ~ALPHANUMERIC_FOLDED.member, fold_case=False)
_CAPITALS = (_CODE >= 65) & (_CODE <= 90)
SHARE = 4.0  # what a feature counts that all words have
_CAPITAL, _REPEAT, _KIND = (np.uint64(x) for x in (0xC0FFEE01, 0xC0FFEE02, 0xC0FFEE03))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the features of a slice's texts; ``part`` has words of letters and digits."""
    row, n = part.row_of, part.count
    total = np.maximum(np.bincount(row, minlength=n), 1)
    words = np.unique((row << BUCKET_BITS) | _bucket(part.hashes))  # a word counts once

    starts, _, kinds = scan(part.raw, part.text_at, _PUNCTUATION)
    capitals = np.concatenate([[0], np.cumsum(_CAPITALS[part.raw])])
    size = part.ends - part.starts
    all_caps = row[(size > 1) & (capitals[part.ends] - capitals[part.starts] == size)]
    again = row[1:][(part.hashes[1:] == part.hashes[:-1]) & (row[1:] == row[:-1])]
    of = np.concatenate([np.searchsorted(part.text_at, starts, side="right") - 1, all_caps, again])
    kind = np.concatenate([kinds ^ _KIND, np.full(len(all_caps), _CAPITAL), np.full(len(again), _REPEAT)])
    shares, times = np.unique((of << BUCKET_BITS) | _bucket(kind), return_counts=True)

    key = np.concatenate([words, shares])
    row = key >> BUCKET_BITS
    value = np.concatenate([np.ones(len(words)), SHARE * np.minimum(times / total[shares >> BUCKET_BITS], 1.0)])
    return row, key & ((1 << BUCKET_BITS) - 1), value


@dataclass
class Model:
    """Weights of the buckets that have any, and the thresholds below the grades from 1 on."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BUCKET_BITS, np.float32)
        out[self.buckets] = self.weights
        return out


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k from 1 on, by row."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -50, 50)))


def fit(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int = GRADES) -> Model:
    """Penalised maximum likelihood, by a fixed number of proximal Adam steps over the whole sample.

    A weight's penalty is as large as chance makes the slope of a feature that means nothing
    (its root mean square by the root of the rows), so rare words are not learnt by heart.
    """
    seen, column, docs = np.unique(bucket, return_inverse=True, return_counts=True)
    often = docs >= MIN_DOCS
    place = np.cumsum(often) - 1
    used = often[column]
    row, column, value = row[used].astype(np.int32), place[column[used]].astype(np.int32), value[used].astype(np.float32)
    seen, n, m = seen[often], len(grade), int(often.sum())
    # Thresholds are the first one and positive gaps, so they stay in order.
    at_least = np.array([np.clip((grade >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, grades)])
    start = -np.log(at_least / (1 - at_least))
    theta = np.concatenate([np.zeros(m), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    penalty = np.zeros_like(theta)
    penalty[:m] = SPARSITY * np.sqrt(np.bincount(column, weights=value**2, minlength=m)) / n
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights=theta[column] * value, minlength=n)
        gaps = np.exp(theta[m + 1 :])
        thresholds = theta[m] + np.concatenate([[0], np.cumsum(gaps)])
        upper = np.concatenate([np.ones((n, 1)), tails(score, thresholds), np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[np.arange(n), grade] - upper[np.arange(n), grade + 1], 1e-9)
        slope = upper * (1 - upper)  # of each tail, by score
        by_score = -(slope[np.arange(n), grade] - slope[np.arange(n), grade + 1]) / p / n
        by_threshold = np.array([(np.where(grade == k, slope[:, k], 0) - np.where(grade == k - 1, slope[:, k], 0)) @ (1 / p) / n for k in range(1, grades)])
        by_weight = np.bincount(column, weights=by_score[row] * value, minlength=m)
        by_gap = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([by_weight, by_gap[:1], by_gap[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = RATE / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        theta -= rate * first / (1 - 0.9**step)
        theta = np.sign(theta) * np.maximum(np.abs(theta) - rate * penalty, 0)
    thresholds = theta[m] + np.concatenate([[0], np.cumsum(np.exp(theta[m + 1 :]))])
    used = np.flatnonzero(theta[:m])
    return Model(seen[used], theta[used].astype(np.float32), thresholds)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: id, grade, text. Out: the features of each row."""
    for batch in batches:
        for part in slices(batch.column(2), ALPHANUMERIC_FOLDED, SCANNED):
            row, bucket, value = features(part)
            order = np.argsort(row, kind="stable")
            at = pa.array(np.searchsorted(row[order], np.arange(part.count + 1)), pa.int32())
            rows = slice(part.first, part.first + part.count)
            columns = [
                batch.column(0)[rows],
                batch.column(1)[rows],
                pa.ListArray.from_arrays(at, pa.array(bucket[order], pa.int32())),
                pa.ListArray.from_arrays(at, pa.array(value[order], pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "grade", "buckets", "values"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` rated documents; None where fewer than two grades are rated."""
    rated = labels.where("quality is not null and toxic is not null and doc_id is not null")
    rated = rated.select(F.col("doc_id").cast("long").alias("id"), F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1).alias("grade"))
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # At most ``sample`` ids of 16 bytes.
    texts = source.join(F.broadcast(rated), "id").select("id", "grade", "text")
    table = texts.mapInArrow(lean(_listed), "id long, grade int, buckets array<int>, values array<float>").dropDuplicates(["id"]).toArrow().sort_by("id")
    grade = table["grade"].to_numpy()
    if len(np.unique(grade)) < 2:
        return None
    lists = table["buckets"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(grade), dtype=np.int32), size)
    bucket, value = lists.flatten().to_numpy(), table["values"].combine_chunks().flatten().to_numpy()
    del table, texts, lists
    tidy(docs.sparkSession)
    model = fit(row, bucket, value, grade)
    # The sample goes before scoring is planned.
    del row, bucket, value
    tidy(docs.sparkSession)
    return model


_WEIGHTS: dict[int, np.ndarray] = {}


def _score(model: Model | None, text_at: int, names: list[str]):
    mark = hash(model.weights.tobytes()) if model else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model and mark not in _WEIGHTS:
            _WEIGHTS.clear()
            _WEIGHTS[mark] = model.dense()
        for batch in batches:
            scores = [np.empty(0)]
            for part in slices(batch.column(text_at), ALPHANUMERIC_FOLDED, SCANNED):
                row, bucket, value = features(part) if model else (np.empty(0, int),) * 3
                weight = _WEIGHTS[mark][bucket] if model else np.empty(0)
                scores.append(np.bincount(row, weights=weight * value, minlength=part.count))
            score = np.concatenate(scores)
            above = tails(score, model.thresholds) if model else np.ones((len(score), GRADES - 1))
            columns = [batch.column(i) for i in range(text_at)]
            columns += [pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(above[:, -1])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def grade(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``keep`` columns of the documents (default: all) as k0, k1, ..., expected grade, and the probabilities of not toxic and of good."""
    keep = docs.columns if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").alias("text"))
    out = source.drop("text").schema.add("expected_grade", "double").add("p_clean", "double").add("p_good", "double")
    return source.mapInArrow(lean(_score(model, len(keep), out.names)), out)


def select_good(docs: DataFrame, model: Model | None, text_col: str = "text", tail: float = TAIL) -> DataFrame:
    """The documents whose probability of the highest grade reaches ``tail``, whole and with all their columns."""
    good = grade(docs, model, text_col=text_col).where(F.col("p_good") >= tail)
    return good.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
