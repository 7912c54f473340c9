"""Column tests, severities, the gate and failing rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trustline.operators import quality as q
from trustline.sources import schemas
from trustline.sources.tables import read_table

RUN_AT = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def tables(spark):
    child = [("a", "p1", 1.0), ("a", "p1", -1.0), ("b", None, None), (None, "gone", 11.0), (None, "gone", 5.0)]
    return {
        "child": spark.createDataFrame(child, "id string, parent_id string, amount double"),
        "parent": spark.createDataFrame([("p1",), ("p1",), ("p2",)], "parent_id string"),
    }


def failures(tables, *specs):
    return {r.test_name: r.failures for r in q.run_tests(tables, list(specs), RUN_AT).collect()}


def test_failure_counts(tables):
    got = failures(
        tables,
        q.Unique("child", "id"),
        q.NotNull("child", "id"),
        q.Relationship("child", "parent_id", parent="parent", parent_column="parent_id"),
        q.Between("child", "amount", lo=0),
    )
    assert got == {
        "unique_child_id": 1,
        "not_null_child_id": 2,
        "relationships_child_parent_id": 2,
        "between_child_amount": 1,
    }


@pytest.mark.parametrize("lo, hi, expected", [(0, 10, 2), (None, 10, 1), (-1, 11, 0), (None, None, 0)])
def test_between_bounds(tables, lo, hi, expected):
    assert list(failures(tables, q.Between("child", "amount", lo=lo, hi=hi)).values()) == [expected]


@pytest.mark.parametrize(
    "severity, warn_if, error_if, count, expected",
    [
        ("error", "> 0", "> 0", 0, "pass"),
        ("error", "> 0", "> 0", 1, "fail"),
        ("error", "> 0", "> 1000", 1000, "warn"),
        ("error", "> 10", "> 1000", 5, "pass"),
        ("warn", "> 0", "> 1000", 2000, "warn"),
        ("warn", "> 0", "> 1000", 0, "pass"),
        ("warn", "> 10", "> 1000", 5, "pass"),
    ],
)
def test_status(spark, severity, warn_if, error_if, count, expected):
    spec = q.NotNull("t", "c", severity, warn_if, error_if)
    row = spark.range(1).select(F.lit(count).alias("failures")).select(spec.status().alias("s")).first()
    assert row.s == expected


def test_results_schema_and_row_tests_share_a_scan(tables):
    results = q.run_tests(tables, [q.NotNull("child", c) for c in ("id", "parent_id", "amount")], RUN_AT)
    assert [f.name for f in results.schema] == schemas.DQ_RESULTS.names
    assert {(r.column_name, r.failures, r.status) for r in results.collect()} == {
        ("id", 2, "fail"), ("parent_id", 1, "fail"), ("amount", 1, "fail"),
    }
    assert results._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_a_table_is_scanned_once_for_its_key_and_row_tests(spark, tables, tmp_path):
    child, parent = (tables[n] for n in ("child", "parent"))
    child.write.parquet(str(tmp_path / "child"))
    stored = {"child": spark.read.parquet(str(tmp_path / "child")), "parent": parent}
    results = q.run_tests(
        stored, [q.Unique("child", "id"), q.NotNull("child", "id"), q.Between("child", "amount", lo=0), q.NotNull("child", "parent_id")], RUN_AT
    )
    assert {r.test_name: r.failures for r in results.collect()} == {
        "unique_child_id": 1, "not_null_child_id": 2, "between_child_amount": 1, "not_null_child_parent_id": 1,
    }
    assert results._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_tests_of_an_empty_table_find_nothing(spark, tables):
    empty = {n: df.limit(0) for n, df in tables.items()}
    specs = [q.Unique("child", "id"), q.NotNull("child", "id"), q.Between("child", "amount", lo=0), q.Unique("parent", "parent_id")]
    assert {r.failures for r in q.run_tests(empty, specs, RUN_AT).collect()} == {0}


def test_gate(spark, tables):
    warned = q.run_tests(tables, [q.NotNull("child", "id", severity="warn")], RUN_AT)
    q.require_no_failures(warned)
    failed = q.run_tests(tables, [q.NotNull("child", "id")], RUN_AT)
    with pytest.raises(q.PipelineGateError, match="not_null_child_id"):
        q.require_no_failures(failed)


def test_log_appends_and_summary(spark, tables, tmp_path):
    path = str(tmp_path / "log")
    specs = [q.NotNull("child", "id"), q.NotNull("parent", "parent_id"), q.Unique("child", "id", severity="warn")]
    q.log_results(q.run_tests(tables, specs, RUN_AT), path)
    q.log_results(q.run_tests(tables, specs, RUN_AT + dt.timedelta(days=1)), path)
    log = read_table(spark, path, schemas.DQ_RESULTS)
    assert log.count() == 6
    assert tuple(q.dq_failure_summary(log).first()) == (RUN_AT, 4)


def test_quarantine(spark):
    flagged = {"is_orphan_order": True, "has_bad_status": True}
    rows = []
    for marks in ({}, flagged, {"has_bad_status": True}):
        row = {f.name: None for f in schemas.FCT_ORDERS} | {f: marks.get(f, False) for f in q.flags.FLAGS}
        rows.append(tuple((row | {"total_amount": 2.0}).values()))
    fct = spark.createDataFrame(rows, schemas.FCT_ORDERS)
    assert sorted(r.reasons for r in q.quarantine_rows(fct).collect()) == [
        ["has_bad_status"], ["is_orphan_order", "has_bad_status"],
    ]
    assert {tuple(r) for r in q.quarantine_by_reason(fct).collect()} == {
        ("has_bad_status", 2, 4.0), ("is_orphan_order", 1, 2.0),
    }
