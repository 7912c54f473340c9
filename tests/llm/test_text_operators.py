import random

import pytest
from brute import components, contamination, repeats, sha, shingles
from pyspark.sql import functions as F

from trustline.llm.decontaminate import contaminated, decontaminate, find_benchmark
from trustline.llm.neardup import agreement, drop_near_duplicates, estimate, find_groups, keeps, minima, packed_bits
from trustline.llm.passages import PhraseAutomaton, drop_repeats, find_repeats

SCHEMA = "doc_id long, text string, key string, report int, class long"


def made(seed, n=60, vocabulary=400):
    """Texts with shared passages, copies, near copies, hot phrases, NULLs and empty ones."""
    rng = random.Random(seed)
    word = lambda: f"W{rng.randrange(vocabulary)}" if rng.random() < 0.9 else rng.choice(["the", "The", "é漢", "x,"])
    passage = [" ".join(word() for _ in range(rng.choice([13, 14, 30, 60]))) for _ in range(6)]
    docs = [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "few words"), (1004, "few words"), (None, passage[0]), (None, passage[0] + " more")]
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randrange(40))) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(3), rng.choice(passage))
        docs.append((rng.randrange(10_000) + 2000 + i * 10_000, rng.choice([" ", "\n", "  "]).join(parts)))
    for _ in range(25):
        i, t = rng.choice(docs[7:])
        w = (t or "").split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            if w:
                w[rng.randrange(len(w))] = word()
        docs.append((rng.randrange(900), " ".join(w)))
    docs.append((5, " ".join(["same"] * 40)))
    docs.append((6, " ".join(["same"] * 30) + " end"))
    docs += docs[8:10]  # repeated rows
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "k", 1, 2) for i, t in docs], SCHEMA).repartition(3)


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_repeats_match_brute_force(spark, held):
    docs = made(1)
    want = repeats(docs)
    got = find_repeats(frame(spark, docs), held=held, stream=5).collect()
    assert len(got) == len(docs)
    for r in got:
        digest = sha(r.kept) if r.kept is not None else r.digest.hex()
        assert sum(s.words for s in r.spans) == r.n_removed
        assert (r.n_words, r.n_removed, digest) in {v for (i, _), v in want.items() if i == r.id}
    assert sorted((r.id or -1, r.n_words, r.n_removed) for r in got) == sorted((i or -1, *want[i, t][:2]) for i, t in docs)
    texts = {r.doc_id: r.text for r in drop_repeats(frame(spark, docs)).collect()}
    assert set(texts) == {i for (i, _), v in want.items() if v[1]}


def test_repeats_of_an_empty_table(spark):
    assert find_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_automaton_finds_windows_by_words():
    machine = PhraseAutomaton(3)
    machine.add(b"a b c d")
    assert machine.starts(b"x a b c a b c d") == [1, 4, 5]
    assert machine.starts(b"ab c d a b") == []


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_contamination_matches_brute_force(spark, block):
    docs = made(2)
    rng = random.Random(3)
    texts = [t for _, t in docs if t and len(t.split()) > 20]
    items = [(k, " ".join(rng.choice(texts).lower().split()[2 : 2 + rng.choice([1, 2, 5, 12, 13, 14, 25])])) for k in range(12)]
    items += [(100, None), (101, ""), (102, "!!!"), (None, items[0][1]), items[1], (3, items[2][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination(docs, items)
    got = find_benchmark(frame(spark, docs), bench, keep=["doc_id", "text", "report"], block=block).collect()
    assert len(got) == len(docs)
    for r in got:
        report = r.report
        assert (report.n_words, report.n_hit, sorted({m.item_id for m in report.matches})) == want[r.k0, r.k1]
        assert r.k2 == 1
    clean = decontaminate(frame(spark, docs), bench)
    assert clean.columns == ["doc_id", "text", "key", "report", "class"]
    assert sorted((i or -1, t or "") for i, t, *_ in clean.collect()) == sorted((i or -1, t or "") for i, t in docs if not (want[i, t][1] and 20 * want[i, t][1] >= want[i, t][0]))


def test_longest_match_is_verbatim(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "start " + item + " end"), (2, item.replace("w20", "other"))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.k0: [tuple(m) for m in r.report.matches] for r in find_benchmark(docs, bench, keep=["doc_id"]).collect()}
    assert got == {1: [("7", 0, 1, 30)], 2: [("7", 0, 0, 20)]}


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, none).count() == 1
    row = find_benchmark(docs, none).select("report.*").withColumn("c", contaminated(F.col("n_hit"), F.col("n_words"))).first()
    assert (row.n_words, row.n_hit, row.c) == (2, 0, False)
    assert decontaminate(docs.limit(0), none).collect() == []


@pytest.mark.parametrize(("threshold", "block"), [(0.85, 2048), (0.8, 3)])
def test_groups_match_brute_force(spark, threshold, block):
    docs = made(4, n=40)
    base = " ".join(f"b{i}" for i in range(60)).split()
    for k in range(12):  # a chain of near copies whose ends are not near
        w = list(base)
        w[: 2 * k] = [f"c{i}" for i in range(2 * k)]
        docs.append((100_000_000 - k, " ".join(w).upper() if k % 2 else " ".join(w)))
    want = components(docs, threshold)
    got = find_groups(frame(spark, docs), threshold=threshold, block=block).collect()
    assert len(got) == len(docs)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.id, r.n_shingles, r.component) for r in got), key=key) == sorted(((i, len(shingles(t)), c) for (i, t), c in zip(docs, want, strict=True)), key=key)
    kept = drop_near_duplicates(frame(spark, docs), threshold=threshold, block=block)
    assert kept.columns == ["doc_id", "text", "key", "report", "class"]
    assert {r.doc_id for r in kept.collect()} - {None} == {i for (i, _), c in zip(docs, want, strict=True) if i == c and i is not None}


def test_groups_of_an_empty_table(spark):
    assert find_groups(spark.createDataFrame([], SCHEMA)).withColumn("k", keeps(F.col("id"), F.col("component"))).collect() == []


def test_low_bits_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for shared in (200, 1000, 1800):
        sets = [np.sort(pool[:2000]), np.sort(np.concatenate([pool[:shared], pool[2000 : 4000 - shared]]))]
        found, row = np.concatenate(sets), np.repeat([0, 1], 2000)
        bits = packed_bits(minima(found, row, 2))
        truth = shared / (4000 - shared)
        assert abs(estimate(agreement(bits[0], bits[1:]))[0] - truth) < 0.15


def test_quality_holds_the_features_of_few_texts_at_once(monkeypatch):
    """A batch of long texts is scored piece by piece, and the same as text by text."""
    import numpy as np
    import pyarrow as pa

    from trustline.llm import quality

    texts = [f"Word{i} and others, again again. " * 3000 for i in range(12)]
    held, own = [], quality.features
    monkeypatch.setattr(quality, "features", lambda part: held.append(len(part.raw)) or own(part))
    model = quality.Model(np.arange(1 << 20), np.linspace(-1, 1, 1 << 20).astype(np.float32), np.array([0.0, 1.0]))

    def scores(*batches):
        run = quality._score(model, 1, ["id", "expected", "clean", "good"])
        rows = [pa.RecordBatch.from_arrays([pa.array(range(len(b))), pa.array(b)], ["id", "text"]) for b in batches]
        return [x for out in run(iter(rows)) for x in out.column(1).to_pylist()]

    together = scores(texts)
    assert max(held) <= 1 << 18
    assert together == scores(*[[t] for t in texts])
