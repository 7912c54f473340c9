"""Landing files: CSV edge cases, quarantine, loads and the snapshot."""

import datetime as dt
import itertools
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from trustline.plans.feed import load_feed
from trustline.sources import landing as lz
from trustline.sources import schemas, tables
from trustline.streaming import load as ld

HEADER = "order_id,customer_id,product_id,quantity,total_amount,order_date,status\n"
CUSTOMERS = "customer_id,name,email,signup_date,region\n"
PRODUCTS = "product_id,category,price,stock_level,product_name\n"


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def order_lines(day, *ids):
    return HEADER + "".join(f"{i},c1,p1,2,20.0,{day},PENDING\n" for i in ids)


@pytest.fixture
def landing(tmp_path):
    root = str(tmp_path / "landing")
    put(root, "customers/customers.csv", CUSTOMERS + 'c1,Ann,a@x,2024-01-01,"Korea, South"\n')
    put(root, "products/products.csv", PRODUCTS + "p1,Home,10.0,3,Cup\n")
    put(root, "orders/orders_2024-01-01.csv", order_lines("2024-01-01", "a", "b"))
    put(root, "orders/orders_2024-01-02.csv", order_lines("2024-01-02", "c"))
    return root


@pytest.fixture
def house(tmp_path):
    return ld.Warehouse(str(tmp_path / "warehouse"))


def ids(df):
    return sorted(r.order_id for r in df.select("order_id").collect())


# --- scan -----------------------------------------------------------------------------


def test_scan_binds_by_position_and_is_all_text(spark, tmp_path):
    put(tmp_path, "products/p.csv", "e,d,c,b,a\np1,Home,10.0,3,Cup\n")
    scanned = lz.good_rows(lz.scan_landing(spark, str(tmp_path), "products"))
    assert scanned.schema == schemas.RAW_PRODUCTS
    assert tuple(scanned.first()) == ("p1", "Home", "10.0", "3", "Cup")


def test_scan_null_markers_and_quoted_comma(spark, tmp_path):
    put(tmp_path, "customers/c.csv", CUSTOMERS + 'c1,NULL,null,,"Korea, South"\nc2,Null,x,y,z\n')
    rows = {r.customer_id: tuple(r) for r in lz.good_rows(lz.scan_landing(spark, str(tmp_path), "customers")).collect()}
    assert rows == {"c1": ("c1", None, None, None, "Korea, South"), "c2": ("c2", "Null", "x", "y", "z")}


def test_unquoted_mode_rejects_a_quoted_comma(spark, tmp_path):
    put(tmp_path, "customers/c.csv", CUSTOMERS + 'c1,Ann,a,b,"Korea, South"\n')
    scanned = lz.scan_landing(spark, str(tmp_path), "customers", quote="")
    assert lz.good_rows(scanned).count() == 0 and lz.malformed_rows(scanned).count() == 1


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    put(tmp_path, "products/p.csv", PRODUCTS + "p1,Home\np2,Home,1,2,Cup,extra\np3,Home,1,2,Cup\n")
    scanned = lz.scan_landing(spark, str(tmp_path), "products")
    assert [r.product_id for r in lz.good_rows(scanned).collect()] == ["p3"]
    bad = lz.malformed_rows(scanned).collect()
    assert lz.good_rows(scanned).select("price").count() == lz.good_rows(scanned).count() == 1
    assert sorted(r.malformed_record for r in bad) == ["p1,Home", "p2,Home,1,2,Cup,extra"]
    assert all(r.source_file.endswith("products/p.csv") for r in bad)


def test_inventory_reads_names_only(spark, landing):
    files = lz.file_inventory(spark, landing)
    assert sorted(r.batch_date for r in files.collect()) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert "content" not in files._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_new_files(spark, landing):
    before = lz.file_inventory(spark, landing).collect()
    ledger = spark.createDataFrame(before, "path string, modificationTime timestamp, length long, batch_date date")
    assert lz.new_files(lz.file_inventory(spark, landing), ledger).isEmpty()
    path = put(landing, "orders/orders_2024-01-03.csv", order_lines("2024-01-03", "d"))
    assert [r.path for r in lz.new_files(lz.file_inventory(spark, landing), ledger).collect()] == [f"file:{path}"]
    os.utime(os.path.join(landing, "orders/orders_2024-01-01.csv"), (1, 1))
    assert lz.new_files(lz.file_inventory(spark, landing), ledger).count() == 2


def test_batch_date_patterns(spark):
    paths = ["x/orders_2024-01-31.csv", "x/batch_date=2024-02-01/part-0.csv", "x/orders_2024-13-01.csv", "x/o.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(lz.batch_date(F.col("p")).alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2024, 1, 31), dt.date(2024, 2, 1), None, None]


def test_batch_date_is_the_first_that_the_path_names(spark):
    names = ["batch_date=2024-02-01", "batch_date=2024-02-0x", "batch_date=2024-13-01", "orders_2024-01-31", "orders_x", "orders_batch_date=2024-03-05", "batch_date=", "x"]
    paths = ["/".join(p) for p in itertools.product(names, names, ["p.csv", "orders_2024-04-01.csv"])]
    day = lz.batch_date(F.col("p"))
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", day.alias("d"))

    def expected(path):
        found = re.search(r"(?:orders_|batch_date=)(\d{4}-\d{2}-\d{2})", path)
        return dt.date.fromisoformat(found[1]) if found and "-13-" not in found[1] else None

    assert {r.p: r.d for r in df.collect()} == {p: expected(p) for p in paths}
    # Scans ask for it in every row: one pattern each time, and for folders one that begins with a text.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_extract\(p#\d+, batch_date=", plan)) == 1 and plan.count("regexp_extract") == 2


def test_only_files_of_the_days_are_opened(spark, landing):
    scan = lz.scan_batches(spark, landing, [dt.date(2024, 1, 2)])
    assert ids(scan) == ["c"]
    metrics = scan._jdf.queryExecution().executedPlan()
    scan.collect()
    leaves = metrics.collectLeaves()
    assert leaves.head().metrics().get("numFiles").get().value() == 1


# --- loads ----------------------------------------------------------------------------


def test_incremental_load_takes_each_file_once(spark, landing, house):
    for _ in range(2):
        ld.run_load(spark, landing, house)
        assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c"]
    put(landing, "orders/orders_2024-01-03.csv", order_lines("2024-01-03", "d"))
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "d"]
    assert ld.raw_dimension(spark, house, "customers").first().region == "Korea, South"
    counts = {r.table_name: r.cnt for r in ld.loaded_counts(spark, house).collect()}
    assert counts == {"Customers": 1, "Products": 1, "Orders": 4}


def test_late_file_adds_to_its_day(spark, landing, house):
    ld.run_load(spark, landing, house)
    put(landing, "orders/late/orders_2024-01-01.csv", order_lines("2024-01-01", "x"))
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "x"]


def test_one_day_over_several_micro_batches(spark, landing, house):
    for i in range(4):
        put(landing, f"orders/{i}/orders_2024-01-01.csv", order_lines("2024-01-01", f"x{i}"))
    ld.load_new_orders(spark, landing, house, max_files_per_trigger=1)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "x0", "x1", "x2", "x3"]


def test_relanded_day_replaces_its_rows(spark, landing, house, tmp_path):
    root = str(tmp_path / "other")
    orders = spark.createDataFrame([("a", "c1", "p1", "1", "1.0", "2024-01-05", "PENDING")], schemas.RAW_ORDERS)
    batch = orders.withColumn("batch_date", F.lit(dt.date(2024, 1, 5)))
    other_day = batch.withColumn("batch_date", F.lit(dt.date(2024, 1, 6))).withColumn("order_id", F.lit("z"))
    lz.land_dimension(spark.createDataFrame([], schemas.RAW_CUSTOMERS), root, "customers")
    lz.land_dimension(spark.createDataFrame([], schemas.RAW_PRODUCTS), root, "products")
    lz.land_batches(batch.union(other_day), root)
    ld.run_load(spark, root, house)
    lz.land_batches(batch.withColumn("order_id", F.lit("b")), root)
    ld.run_load(spark, root, house)
    assert ids(ld.raw_orders(spark, house)) == ["b", "z"]


@pytest.fixture
def rebuilds(monkeypatch):
    """The days of each rebuild, in order."""
    calls, rebuild = [], ld.rebuild_days
    monkeypatch.setattr(ld, "rebuild_days", lambda spark, landing, house, days: (calls.append(sorted(days)), rebuild(spark, landing, house, days)))
    return calls


def test_relanded_day_is_rebuilt_once(spark, landing, house, rebuilds):
    ld.run_load(spark, landing, house)
    os.remove(os.path.join(landing, "orders/orders_2024-01-01.csv"))
    put(landing, "orders/again/orders_2024-01-01.csv", order_lines("2024-01-01", "a2"))
    rebuilds.clear()
    for _ in range(2):
        ld.run_load(spark, landing, house)
        assert rebuilds == [[dt.date(2024, 1, 1)]]
        assert ids(ld.raw_orders(spark, house)) == ["a2", "c"]


def test_file_that_goes_while_its_day_is_rebuilt_is_found(spark, landing, house, monkeypatch):
    late = put(landing, "orders/late/orders_2024-01-01.csv", order_lines("2024-01-01", "x"))
    ld.run_load(spark, landing, house)
    os.remove(os.path.join(landing, "orders/orders_2024-01-01.csv"))
    put(landing, "orders/again/orders_2024-01-01.csv", order_lines("2024-01-01", "a2"))
    load = ld.load_new_orders
    monkeypatch.setattr(ld, "load_new_orders", lambda *args: (load(*args), os.remove(late))[0])
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a2", "c"]


def test_replayed_micro_batch_changes_nothing(spark, landing, house):
    ld.run_load(spark, landing, house)
    commits = os.path.join(house.checkpoint, "commits")
    newest = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c"]


def test_old_file_that_arrives_late_is_loaded(spark, landing, house):
    ld.run_load(spark, landing, house)
    path = put(landing, "orders/orders_2023-12-01.csv", order_lines("2023-12-01", "old"))
    os.utime(path, (1.6e9, 1.6e9))
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "old"]


def test_rewritten_file_replaces_its_rows(spark, landing, house):
    ld.run_load(spark, landing, house)
    path = put(landing, "orders/orders_2024-01-02.csv", order_lines("2024-01-02", "c", "c2"))
    os.utime(path, (4e9, 4e9))
    for _ in range(2):
        ld.run_load(spark, landing, house)
        assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "c2"]
    notes = spark.read.parquet(house.files)
    assert notes.where("load_id like 'change-%'").count() == 1 and notes.count() == 3


def test_merged_ledger_knows_every_file(spark, landing, house):
    ld.run_load(spark, landing, house)
    path = put(landing, "orders/orders_2024-01-02.csv", order_lines("2024-01-02", "c2"))
    os.utime(path, (4e9, 4e9))
    ld.run_load(spark, landing, house)
    assert not ld.compact_ledger(spark, house)
    assert ld.compact_ledger(spark, house, max_notes=1)
    notes = spark.read.parquet(house.files)
    assert notes.count() == 2 and notes.where("load_id like 'merged-%'").count() == 2
    before = spark.read.parquet(house.orders).inputFiles()
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c2"]
    assert sorted(spark.read.parquet(house.orders).inputFiles()) == sorted(before)


def test_load_report_counts_per_file(spark, landing, house):
    put(landing, "orders/orders_2024-01-04.csv", HEADER + "y,z\nbad,line\nok,c1,p1,1,10.0,2024-01-04,PENDING\n")
    put(landing, "products/more.csv", "product_id,category,price,stock_level,product_name\nonly\n")
    ld.run_load(spark, landing, house)
    report = {os.path.basename(r.source_file): r for r in ld.load_report(spark, house).collect()}
    order = report["orders_2024-01-04.csv"]
    assert (order.entity, order.row_count, order.rejected, order.first_error) == ("orders", 1, 2, "bad,line")
    more = report["more.csv"]
    assert (more.entity, more.row_count, more.rejected, more.first_error) == ("products", 0, 1, "only")
    assert {r.entity for r in report.values()} == {"orders", "customers", "products"}
    lines = {(r.entity, r.malformed_record) for r in ld.quarantined_lines(spark, house).collect()}
    assert lines == {("orders", "y,z"), ("orders", "bad,line"), ("products", "only")}


def test_full_load_starts_over(spark, landing, house):
    ld.run_load(spark, landing, house)
    os.remove(os.path.join(landing, "orders/orders_2024-01-02.csv"))
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c"]
    ld.run_load(spark, landing, house, "full")
    assert ids(ld.raw_orders(spark, house)) == ["a", "b"]
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b"]


def test_full_load_of_an_incomplete_landing_zone_deletes_nothing(spark, landing, house, tmp_path):
    ld.run_load(spark, landing, house)
    elsewhere = str(tmp_path / "elsewhere")
    put(elsewhere, "customers/customers.csv", CUSTOMERS)
    with pytest.raises(tables.MissingDimensionError, match="products"):
        ld.run_load(spark, elsewhere, house, "full")
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c"]


def test_dimension_that_is_not_landed_stays(spark, landing, house, tmp_path):
    ld.run_load(spark, landing, house)
    elsewhere = str(tmp_path / "elsewhere")
    put(elsewhere, "customers/customers.csv", CUSTOMERS + "c9,Bo,b@x,2024-01-01,EU\n")
    ld.load_dimensions(spark, elsewhere, house)
    assert ld.raw_dimension(spark, house, "customers").first().customer_id == "c9"
    assert ld.raw_dimension(spark, house, "products").first().product_id == "p1"


def test_load_keeps_malformed_lines(spark, landing, house):
    put(landing, "orders/orders_2024-01-04.csv", HEADER + "bad,line\nok,c1,p1,1,10.0,2024-01-04,PENDING\n")
    ld.run_load(spark, landing, house)
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "ok"]
    (bad,) = ld.quarantined_lines(spark, house).collect()
    assert bad.malformed_record == "bad,line" and bad.batch_date == dt.date(2024, 1, 4)


def test_undated_file_stops_the_load(spark, landing, house):
    put(landing, "orders/orders.csv", order_lines("2024-01-04", "q"))
    with pytest.raises(Exception, match="no batch date"):
        ld.run_load(spark, landing, house)


def test_unknown_mode(spark, landing, house):
    with pytest.raises(ValueError):
        ld.run_load(spark, landing, house, "some")


def test_raw_rows_have_a_stable_identity(spark, landing, house):
    ld.run_load(spark, landing, house)
    raw = ld.raw_orders(spark, house)
    assert raw.select("row_id").distinct().count() == 3
    assert sorted(raw.collect()) == sorted(ld.raw_orders(spark, house).collect())


def test_nothing_loaded_yet(spark, house):
    assert ld.raw_orders(spark, house).count() == 0 and ld.quarantined_lines(spark, house).count() == 0


# --- sinks ----------------------------------------------------------------------------


def test_scratch_folder_is_in_the_shared_storage():
    class Session:
        def __init__(self, shared):
            self.conf = {"spark.checkpoint.dir": shared} if shared else {}

    first, second = (tables.scratch_folder(Session("hdfs://shared/cp/"), "x") for _ in range(2))
    assert first.startswith("hdfs://shared/cp/trustline-x-") and first != second
    assert os.path.isdir(tables.scratch_folder(Session(None), "x"))


def test_require_dimensions(spark, tmp_path):
    path = str(tmp_path / "customers")
    with pytest.raises(tables.MissingDimensionError, match="customers"):
        tables.require_dimensions(spark, {"customers": path})
    tables.write_dimension(spark.range(2), path)
    tables.write_dimension(spark.range(1), path)
    assert tables.require_dimensions(spark, {"customers": path})["customers"].count() == 1


def test_daily_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    day = lambda d, v: spark.createDataFrame([(v, d)], "v int, batch_date string")
    tables.write_daily(day("2024-01-01", 1).union(day("2024-01-02", 2)), path, cluster=True)
    tables.write_daily(day("2024-01-02", 3), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]


def test_stored_rows_are_zstd_and_dimensions_are_not(spark, landing, house, tmp_path):
    ld.run_load(spark, landing, house)
    stored = tables.materialise(ld.raw_orders(spark, house), str(tmp_path / "stored"))
    for rows in (ld.raw_order_batches(spark, house), stored):
        assert all(f.endswith(".zstd.parquet") for f in rows.inputFiles())
    assert not any(".zstd." in f for f in ld.raw_dimension(spark, house, "customers").inputFiles())


def test_writes_leave_no_dealt_rows_on_the_disks(spark, landing, tmp_path):
    """The files of shuffles go when a write ends, not when the driver collects its garbage."""

    def dealt():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}

    rows = lz.scan_batches(spark, str(landing)).select(*schemas.RAW_ORDERS.names, "batch_date")
    for write in (
        lambda: lz.land_batches(rows, str(tmp_path / "landed")),
        lambda: tables.materialise(rows.distinct(), str(tmp_path / "table")),
        lambda: tables.export_snapshot(rows.groupBy("status").count(), str(tmp_path / "snapshot")),
    ):
        before = dealt()
        write()
        for _ in range(50):
            left = dealt() - before
            if not left:
                break
            time.sleep(0.1)
        assert not left
    assert spark.conf.get(tables.FREE) == "false"


def test_materialise_as_path_and_table(spark, tmp_path):
    assert tables.materialise(spark.range(3), str(tmp_path / "m")).count() == 3
    for n in (2, 4):
        assert tables.materialise(spark.range(n), "mart_test", as_table=True).count() == n
    spark.sql("drop table mart_test")


@pytest.fixture
def feed(spark):
    rows = [(dt.date(2024, 1, 1), "PENDING", 2, 20.5, 10.25, 1, 0, 0, 0, 0, 0), (None, None, 1, None, None, *[0] * 6)]
    return spark.createDataFrame(rows, schemas.FEED)


def test_snapshot_roundtrip(spark, feed, tmp_path):
    path = str(tmp_path / "snapshot")
    assert tables.read_snapshot(spark, path).count() == 0
    tables.export_snapshot(feed, path)
    assert sorted(map(repr, tables.read_snapshot(spark, path).collect())) == sorted(map(repr, feed.collect()))
    files = [n for n in os.listdir(path) if n.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(path, files[0])) as f:
        assert f.readline().strip() == ",".join(schemas.FEED.names)


def test_feed_falls_back_to_the_snapshot(spark, feed, tmp_path):
    snapshot = str(tmp_path / "snapshot")
    assert load_feed(spark, None, snapshot).count() == 0
    tables.export_snapshot(feed, snapshot)
    assert load_feed(spark, "no_such_table", snapshot).count() == 2
    assert load_feed(spark, str(tmp_path / "no_mart"), snapshot).count() == 2
    unfit = str(tmp_path / "unfit")
    spark.range(1).write.parquet(unfit)
    assert load_feed(spark, unfit, snapshot).count() == 2


def test_reset_landing(spark, landing, tmp_path):
    for path in ("", "  ", "/"):
        with pytest.raises(ValueError):
            lz.reset_landing(spark, path)
    assert lz.reset_landing(spark, landing) and not os.path.exists(landing)
    assert not lz.reset_landing(spark, landing)


def test_hostile_texts_survive_the_landing_zone(spark, tmp_path):
    texts = [" SHIPPED ", 'say "hi", Lee', '""', '"', "back\\slash\\", "a,b", "x", "SHIP\nPED", "tail\r", "a\r\nb", '\n"\n",\n', "\n\n1,2,3\n", "tail\n"]
    rows = [(str(i), "c", "p", "1", "2.0", "2024-01-01", t, dt.date(2024, 1, 1)) for i, t in enumerate(texts)]
    orders = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, quantity string, total_amount string, order_date string, status string, batch_date date")
    lz.land_batches(orders, str(tmp_path))
    scanned = lz.scan_batches(spark, str(tmp_path))
    assert lz.malformed_rows(scanned).isEmpty()
    assert {int(r.order_id): r.status for r in lz.good_rows(scanned).collect()} == dict(enumerate(texts))


def test_hostile_texts_survive_the_snapshot(spark, tmp_path):
    names = schemas.FEED.names
    texts = ["X", " X", 'a "b", c', "two\nlines", "back\\"]
    feed = spark.createDataFrame([(dt.date(2024, 1, 1), t, *[1] * 1, 1.0, 1.0, *[1] * 6) for t in texts], schemas.FEED)
    for single in (False, True):
        tables.export_snapshot(feed, str(tmp_path / f"feed{single}"), single_file=single)
        back = tables.read_snapshot(spark, str(tmp_path / f"feed{single}"))
        assert back.columns == names and sorted(r.status for r in back.collect()) == sorted(texts)


def test_an_unreadable_mart_falls_back_to_the_snapshot(spark, tmp_path):
    feed = spark.createDataFrame([(dt.date(2024, 1, 1), "X", 1, 1.0, 1.0, *[1] * 6)], schemas.FEED)
    tables.export_snapshot(feed, str(tmp_path / "feed"))
    mart = tmp_path / "mart"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FCT_ORDERS)
    spark.createDataFrame([], columns).coalesce(1).write.parquet(str(mart))
    whole = next(mart.glob("part-*.parquet"))
    (mart / "part-damaged.parquet").write_bytes(whole.read_bytes()[:-20] + b"no parquet at all...")
    assert [r.status for r in load_feed(spark, str(mart), str(tmp_path / "feed")).collect()] == ["X"]


# --- replay ---------------------------------------------------------------------------


def test_replay_takes_corrected_lines_in_once(spark, landing, house):
    put(landing, "orders/orders_2024-01-03.csv", order_lines("2024-01-03", "e") + "f,c1\nf,c1\ng,c1\nh,c1\ni,c1\n")
    put(landing, "products/more.csv", PRODUCTS + "p2,Home\n")
    ld.run_load(spark, landing, house)
    bad = ld.quarantined_lines(spark, house)
    full = {"f,c1": "f,c1,p1,2,20.0,2024-01-03,NULL", "g,c1": "g,c1,p1", "h,c1": 'h,c1,p1,2,20.0,2024-01-03,"SHIP', "p2,Home": "p2,Home,1.0,4,Pan"}
    lines = spark.createDataFrame(list(full.items()), "malformed_record string, corrected string")
    # A frame of its own: a cached one is read anew when the table below it is written.
    fixes = tables.materialise(bad.join(lines, "malformed_record").select("entity", "source_file", "malformed_record", "corrected"), f"{house.root}/fixes")
    orders = fixes.where("entity = 'orders'")
    days = [ld.replay(spark, landing, house, orders) for _ in range(2)]
    assert days[0] == days[1] == [dt.date(2024, 1, 3)]
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "e", "f", "f"]
    assert {r.status for r in ld.raw_orders(spark, house).where("order_id = 'f'").collect()} == {None}
    left = ld.quarantined_lines(spark, house).where("entity = 'orders'")
    assert sorted(r.malformed_record for r in left.collect()) == ["g,c1", "h,c1", "i,c1"]

    assert ld.replay(spark, landing, house, fixes.where("entity = 'products'"), "products") == []
    assert sorted(r.product_id for r in ld.raw_dimension(spark, house, "products").collect()) == ["p1", "p2"]

    ld.run_load(spark, landing, house, "full")  # corrections outlive the tables
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "e", "f", "f"]
    ld.replay(spark, landing, house, orders.withColumn("corrected", F.lit(None).cast("string")))
    assert ids(ld.raw_orders(spark, house)) == ["a", "b", "c", "e"]
