"""The log of landed windows: fences, leases and counts; drifted headers and removed files."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from trustline.plans import marks
from trustline.plans import pipeline as pl
from trustline.sources import landing as lz
from trustline.streaming import load as ld

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))
HEADER = "order_id,customer_id,product_id,quantity,total_amount,order_date,status\n"


@pytest.fixture
def house(tmp_path):
    return ld.Warehouse(str(tmp_path / "warehouse"))


def log(spark, house):
    return [(r.number, r.state, r.end, r.rows) for r in marks.steps(spark, house).orderBy("number").collect()]


def test_a_second_run_is_refused_before_it_lands(spark, house):
    assert log(spark, house) == []
    with marks.landing(spark, house, D1, D2) as counts:
        with pytest.raises(marks.ConcurrentRunError), marks.landing(spark, house, D1, D2):
            raise AssertionError("landed")
        counts["rows"] = 7
    assert log(spark, house) == [(1, "landing", D2, None), (2, "landed", D2, 7)]
    assert marks.landed_days(spark, house).first().batch_date == D2


def test_a_failed_window_is_given_back(spark, house):
    with pytest.raises(ZeroDivisionError), marks.landing(spark, house, D1, D1):
        raise ZeroDivisionError
    with marks.landing(spark, house, D1, D1):
        pass
    assert [s for _, s, *_ in log(spark, house)] == ["landing", "failed", "landing", "landed"]


def test_a_run_whose_claim_was_taken_over_cannot_move_the_mark(spark, house):
    with pytest.raises(marks.ConcurrentRunError), marks.landing(spark, house, D1, D3):
        # Its lease has run out, and another run lands the window.
        with marks.landing(spark, house, D1, D2, lease=0):
            pass
    assert [(s, e) for _, s, e, _ in log(spark, house)] == [("landing", D3), ("landing", D2), ("landed", D2)]
    assert pl.read_high_water(spark, house).first().high_water == D2


def test_of_many_runs_at_once_one_claims(spark, house):
    won, lost = [], []

    def run(i):
        try:
            won.append(marks.claim(spark, house, D1, D2, str(i)))
        except marks.ConcurrentRunError:
            lost.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) + len(lost) == 3 and set(won) == {1}
    assert len(log(spark, house)) == 1


def test_an_older_mark_never_wins(spark, house):
    for day in (D2, D3, D1):
        pl.commit_high_water(spark, house, day)
    assert pl.read_high_water(spark, house).first().high_water == D3


def test_rows_are_counted_as_they_are_written(spark, house, tmp_path):
    source = spark.range(30).select(
        *[F.lit("1").alias(c) for c in lz.RAW["orders"].names], F.date_add(F.lit(D1), (F.col("id") / 10).cast("int")).alias("batch_date")
    )
    cfg = pl.Config(str(tmp_path / "landing"), house.root, str(tmp_path / "snapshot"))
    pl.commit_high_water(spark, house, D1)
    assert pl.ingest(spark, cfg, source, D2) == 1
    step = marks.steps(spark, house).where("rows IS NOT NULL").first()
    assert (step.state, step.start, step.end, step.rows, step.outside, step.undated) == ("landed", D2, D2, 10, 20, 0)
    assert lz.good_rows(lz.scan_batches(spark, cfg.landing)).count() == 10


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_headers_that_drift_are_told(spark, tmp_path):
    names = HEADER.strip().split(",")
    files = {
        "a_orders_2024-01-01.csv": HEADER,
        "b_orders_2024-01-01.csv": "﻿" + HEADER.upper().replace("\n", "\r\n"),
        "c_orders_2024-01-02.csv": ",".join([names[1], names[0], *names[2:]]) + "\n",
        "d_orders_2024-01-02.csv": ",".join(f'"{c}"' for c in names) + "\n",
        "e_orders_2024-01-03.csv": ",".join([*names[:-1], "state", "extra"]) + "\n",
        "f_orders_2024-01-03.csv": "",
    }
    for name, text in files.items():
        put(str(tmp_path), f"orders/{name}", text + "1,2,3,4,5,6,7\n" if text else "")
    found = {r.source_file.rsplit("/", 1)[1][0]: r for r in lz.headers(spark, str(tmp_path), "orders").collect()}
    assert {k: r.status for k, r in found.items()} == {"a": "ok", "b": "ok", "c": "moved", "d": "ok", "e": "renamed"}
    assert (found["e"].missing, found["e"].extra, found["e"].batch_date) == ("status", "extra,state", D3)


def rows(*ids):
    return HEADER + "".join(f"{i},c1,p1,2,20.0,2024-01-01,PENDING\n" for i in ids)


def test_a_day_equals_its_remaining_files(spark, house, tmp_path):
    root = str(tmp_path / "landing")
    first = put(root, "orders/x/orders_2024-01-01.csv", rows("a", "b"))
    put(root, "orders/y/orders_2024-01-01.csv", rows("c"))
    old = put(root, "orders/orders_2024-01-02.csv", rows("d"))

    def loaded():
        ld.run_load(spark, root, house)
        return sorted(r.order_id for r in ld.raw_orders(spark, house).collect())

    assert loaded() == ["a", "b", "c", "d"]
    os.remove(first)
    assert loaded() == ["c", "d"] and loaded() == ["c", "d"]
    # Renamed, rewritten under the old name, and a whole day that is moved away and stays.
    os.rename(f"{root}/orders/y/orders_2024-01-01.csv", f"{root}/orders/y/orders_2024-01-01.z.csv")
    assert loaded() == ["c", "d"]
    put(root, "orders/x/orders_2024-01-01.csv", rows("e"))
    os.remove(old)
    assert loaded() == ["c", "d", "e"] and loaded() == ["c", "d", "e"]
    put(root, "orders/orders_2024-01-02.csv", rows("f"))
    assert loaded() == ["c", "e", "f"]
