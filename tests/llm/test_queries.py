import corpus_pipeline
import pytest
from brute import components, contamination
from check_oracle import compare, connect
from pyspark.sql import functions as F

from __spark_entry__ import queries
from trustline.llm.mixing import WORD, default_weights, targets
from trustline.llm.oracle import ORACLES
from trustline.llm.queries import QUERIES
from trustline.llm.shared import stored


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    ok, rows, why = compare(spark, duck, QUERIES[name], ORACLES[name], sf)
    assert ok, why
    assert rows > 0


def test_all_operators_and_the_pipeline_are_registered():
    found = sorted(int(n[2:].split("_")[0]) for n in queries() if n.startswith("op"))
    assert found == list(range(1, 14)) and "pipeline" in queries()


def test_stages_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = stored(stage(spark, docs, sf), name)
        if name != "training_order":
            assert out[name].columns == docs.columns
        before, docs = docs, out[name]
        rows = [(r.doc_id, r.text) for r in before.collect()]
        left = sorted(r.doc_id for r in out[name].collect())
        if name == "quality":
            good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
            assert len(good & {i for i, _ in rows} & set(left)) > 0.9 * len(good & {i for i, _ in rows})
        elif name == "near_duplicates":
            assert left == sorted(i for (i, _), c in zip(rows, components(rows, 0.8), strict=True) if i == c)
        elif name == "contamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            found = contamination(rows, items)
            assert left == sorted(i for (i, _), (n, hit, _) in found.items() if not (hit and 20 * hit >= n))
        elif name == "mixture":
            size = F.regexp_count("text", F.lit(WORD))
            had = {r.source: r.n for r in before.groupBy("source").agg(F.sum(size).alias("n")).collect()}
            has = {r.source: r.n for r in out[name].groupBy("source").agg(F.sum(size).alias("n")).collect()}
            longest = before.agg(F.max(size)).first()[0]
            want = targets(had, default_weights(had))
            assert all(abs(has.get(s, 0) - t) <= longest for s, t in want.items())
            assert max(left.count(i) for i in set(left)) <= 3
        else:
            slots = [r.slot for r in out[name].collect()]
            assert sorted(slots) == list(range(len(slots)))
            assert set(left) == {i for i, _ in rows}


def test_pipeline_of_an_empty_table(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
