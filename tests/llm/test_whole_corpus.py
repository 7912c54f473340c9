from collections import Counter

from pyspark.sql import functions as F

from trustline.llm import mixing
from trustline.llm.neardup import drop_near_duplicates


def test_one_row_of_each_component_stays(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    rows = [(None, text("a"))] * 6 + [(None, text("a") + " end")] * 2  # without any id
    rows += [(7, text("b"))] * 5 + [(7, text("b") + " end"), (9, text("b"))]  # repeated ids
    rows += [(None, text("c")), (3, text("c")), (3, text("c"))] + [(5, text("d")), (None, ""), (None, None), (4, "")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, part int").repartition(3)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter((r.text or "")[:1] for r in got) == {"a": 1, "b": 1, "c": 1, "d": 1, "": 3}
    assert {(r.text[0], r.doc_id) for r in got if r.text} == {("a", None), ("b", 7), ("c", 3), ("d", 5)}
    assert sorted(kept.collect(), key=str) == sorted(drop_near_duplicates(docs.repartition(2)).collect(), key=str)


def test_mix_gives_its_target_with_alike_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    rows = [(None, "x y z", "a")] * 700 + [(5, "x y z", s) for s in "bc" * 40] + [(i, f"p q {i}", "bc"[i % 2]) for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    goal = {r.source: r.target for r in mixing.schedule(docs, block=16)[0].select("source", "target").distinct().collect()}
    size = F.regexp_count("text", F.lit(mixing.WORD))
    got = {r.source: r.n for r in mixing.mix(docs, block=16).groupBy("source").agg(F.sum(size).alias("n")).collect()}
    assert set(got) == set(goal) and all(abs(got[s] - goal[s]) <= 3 for s in goal)
