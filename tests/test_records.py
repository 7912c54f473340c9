"""Records over several lines, put together block by block, against the csv module."""

import csv
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from trustline.sources import landing as lz
from trustline.sources import records

HEADER = "product_id,category,price,stock_level,product_name\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return path


@pytest.fixture
def blocks_of(spark):
    """Files are cut into blocks of so many bytes."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for k, v in held.items():
        spark.conf.set(k, v)


def scanned(spark, root):
    rows = lz.scan_landing(spark, str(root), "products")
    good = [tuple("" if x is None else x for x in r) for r in lz.good_rows(rows).collect()]
    return sorted(good), sorted(r.malformed_record for r in lz.malformed_rows(rows).collect())


@pytest.mark.parametrize("size", [1 << 27, 211, 40])
def test_hostile_files_are_read_as_the_csv_module_does(spark, tmp_path, blocks_of, size):
    rng = random.Random(size)
    alphabet = ["x", "\n", '"', ",", "y", "\r\n", "\r", " ", "é", "\n\n", '""', '",', ',"']
    expected = []
    for f, ends in enumerate(["\n", "\r\n", "\n"]):
        rows = [[f"{f}-{i}", *("".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(3)), "z"] for i in range(150)]
        text = io.StringIO()
        csv.writer(text, lineterminator=ends).writerows([["a", "b", "c", "d", "e"], *rows])
        put(tmp_path / "products" / f"{f}.csv", text.getvalue())
        expected += [tuple(r) for r in rows]
    blocks_of(size)
    lines = records.read_lines(spark, str(tmp_path / "products"))
    assert lines.select("file", "block").distinct().count() > (20 if size < 1000 else 2)
    good, bad = scanned(spark, tmp_path)
    assert bad == [] and good == sorted(expected)


UNCLOSED = HEADER + 'p1,Home,1.0,3,"Cup\np2,Home,1.0,3,Pot\np3,"a ""b"", c",2.0,1,"Pan"\np4,Home,1,2,"Two\nlines"\np5,x,1,1,5" pipe\np6,Home,1.0,3,"End\np7,Home,1.0,3,Last\n'


@pytest.mark.parametrize("size", [1 << 27, 30])
def test_an_unclosed_quote_is_malformed_and_takes_nothing_along(spark, tmp_path, blocks_of, size):
    put(tmp_path / "products" / "p.csv", UNCLOSED)
    blocks_of(size)
    good, bad = scanned(spark, tmp_path)
    assert bad == ['p1,Home,1.0,3,"Cup', 'p6,Home,1.0,3,"End']
    assert good == [
        ("p2", "Home", "1.0", "3", "Pot"), ("p3", 'a "b", c', "2.0", "1", "Pan"), ("p4", "Home", "1", "2", "Two\nlines"),
        ("p5", "x", "1", "1", '5" pipe'), ("p7", "Home", "1.0", "3", "Last"),
    ]


def test_a_quote_that_closes_too_far_on_is_unclosed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MAX_LINES", 3)
    near, far = 'p1,x,1,1,"a\n\n\nb"\n', 'p2,x,1,1,"a\n\n\n\nb"\n'
    put(tmp_path / "products" / "p.csv", HEADER + near + far)
    good, bad = scanned(spark, tmp_path)
    assert good == [("p1", "x", "1", "1", "a\n\n\nb")] and bad == ['b"', 'p2,x,1,1,"a']


def test_wrong_field_counts_over_lines_are_malformed_as_a_whole(spark, tmp_path):
    put(tmp_path / "products" / "p.csv", HEADER + 'p1,"x\ny",1\n\n  \np2,x,1,2,Cup\n')
    good, bad = scanned(spark, tmp_path)
    assert good == [("p2", "x", "1", "2", "Cup")] and bad == ['p1,"x\ny",1']


def test_files_of_single_lines_are_not_shuffled(spark, tmp_path):
    put(tmp_path / "products" / "p.csv", HEADER + 'p1,"a, b",1,2,"say ""hi"""\n' * 5)
    rows = lz.scan_landing(spark, str(tmp_path), "products")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString() and rows.count() == 5
    put(tmp_path / "products" / "q.csv", HEADER + 'q1,"a\nb",1,2,x\n')
    files = records.files_with_open_lines(records.read_lines(spark, str(tmp_path / "products")), '"')
    assert [r.file.rsplit("/", 1)[1] for r in files.collect()] == ["q.csv"]
    assert len(scanned(spark, tmp_path)[0]) == 6


def test_lines_without_a_quote_are_passed_over_in_compiled_code(spark, tmp_path):
    """The first pass reads every line of a load; what looks into quotes is not compiled, and would take the filter along."""
    put(tmp_path / "products" / "p.csv", HEADER + 'p1,a,1,2,b\np2,"a",1,2,b\n' * 5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files = records.files_with_open_lines(records.read_lines(spark, str(tmp_path / "products"), None, '"'), '"')
        plan = files._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    filters = [line for line in plan.splitlines() if "Filter (" in line and "Contains(value" in line and "FileScan" not in line]
    assert filters and all(re.search(r"\*\(\d+\) Filter", line) for line in filters)
    assert files.isEmpty()


def test_no_single_task_sees_a_whole_file(spark, tmp_path, blocks_of):
    put(tmp_path / "products" / "p.csv", HEADER + 'p1,"a\nb",1,2,x\n' * 400)
    blocks_of(500)
    lines = records.read_lines(spark, str(tmp_path / "products"))
    assert lines.groupBy("file", "block").count().agg(F.max("count")).first()[0] < 100
    plan = records.assemble(lines, '"')._jdf.queryExecution().optimizedPlan().toString()
    windows = [w for w in plan.splitlines() if "Window" in w]
    assert windows and all("block" in w or "record" in w for w in windows)  # never by file alone over lines
    assert records.assemble(lines, '"').count() == 401


def test_what_a_task_holds_does_not_grow_with_a_block(spark, tmp_path, monkeypatch):
    """One large block is cut into chunks, lines are dealt by size, and the records are the same."""
    rows = [(f"p{i}", "x", "1", "1", "a\nb\n\nc" if i % 3 == 0 else "d") for i in range(300)]
    text = HEADER + "".join(",".join(f'"{v}"' if "\n" in v else v for v in r) + "\n" for r in rows)
    put(tmp_path / "products" / "p.csv", text + 'q,x,1,1,"open\n')
    monkeypatch.setattr(records, "CHUNK", 7)
    monkeypatch.setattr(records, "TASK_BYTES", 500)
    good, bad = scanned(spark, tmp_path)
    assert good == sorted(rows) and bad == ['q,x,1,1,"open']
    plan = records.assemble(records.read_lines(spark, str(tmp_path / "products")), '"', tasks=9)._jdf.queryExecution().optimizedPlan().toString()
    windows = [w for w in plan.splitlines() if "Window" in w and "nth" in w]
    assert windows and all("chunk" in w for w in windows)
