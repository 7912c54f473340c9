"""Load landing files into the raw tables: full, or only what is new.

What is new is decided by a Structured Streaming file source: its checkpoint is the
ledger of files already taken, and ``availableNow`` processes the backlog and ends.
The stream carries file *names* (no content is read); each micro-batch names the
batch dates it touches, and those days are rebuilt in the raw table from all their
landing files with a dynamic partition overwrite.  So

* a micro-batch that is replayed after a crash writes the same days again;
* a second file for a day that was loaded before adds to it, and loses nothing;
* a day that was landed again replaces its old rows instead of doubling them.

The landing zone is the record of a day: keep a day's files there as long as more may
come for it.

A file source takes each name once and forgets names older than ``MAX_FILE_AGE``, so that
what it holds on the driver is bounded.  Files rewritten under the same name and files that
come later than that are found by a join with the versions noted beside the checkpoint; of
them only their days reach the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustline.operators.monitors import load_row_counts
from trustline.sources import landing as lz
from trustline.sources.schemas import RAW, RAW_ORDERS
from trustline.sources.tables import (
    MissingDimensionError,
    exists,
    hadoop_path,
    materialise,
    read_table,
    row_identity,
    write_daily,
    write_dimension,
)

_FILE = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
]
_BINARY_FILE = T.StructType([*_FILE, T.StructField("content", T.BinaryType())])
_LEDGER = T.StructType(
    [*_FILE, T.StructField("batch_date", T.DateType()), T.StructField("load_id", T.StringType())]
)
_RAW_BATCHES = T.StructType(
    [
        *RAW_ORDERS.fields,
        T.StructField(lz.MALFORMED, T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("batch_date", T.DateType()),
    ]
)
_CORRECTIONS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("source_file", lz.MALFORMED, "corrected", "entity", "replay_id")]
)

DIMENSIONS = ("customers", "products")
# Age against the newest file; older ones are left to the join with the ledger.
MAX_FILE_AGE = "14d"
# Folders of notes the ledger may have before they are merged into one.
MAX_NOTES = 64


class UndatedFileError(ValueError):
    """An order file whose path names no batch date."""


@dataclass(frozen=True)
class Warehouse:
    """Paths of the tables under one root on shared storage."""

    root: str

    @property
    def orders(self) -> str:
        return f"{self.root}/raw_orders"

    @property
    def ledger(self) -> str:
        """Checkpoint of the file stream and, beside it, the versions of the files loaded."""
        return f"{self.root}/_ledger"

    @property
    def checkpoint(self) -> str:
        return f"{self.ledger}/checkpoint"

    @property
    def files(self) -> str:
        return f"{self.ledger}/files"

    def dimension(self, entity: str) -> str:
        return f"{self.root}/raw_{entity}"

    @property
    def corrections(self) -> str:
        """Corrected lines, by entity and replay; a full load keeps them."""
        return f"{self.root}/corrections"

    @property
    def mart(self) -> str:
        """The versions of the mart and of what is stored with it."""
        return f"{self.root}/fct_orders"

    @property
    def results(self) -> str:
        return f"{self.root}/dq_results"

    def monitor(self, name: str) -> str:
        """What the last build left of a monitor, or the rows it set apart (``quarantine``)."""
        return f"{self.root}/monitor_{name}"

    @property
    def marks(self) -> str:
        """The log of landed windows."""
        return f"{self.root}/high_water"


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def landed_dimensions(spark: SparkSession, landing: str) -> list[str]:
    return [e for e in DIMENSIONS if exists(spark, f"{landing}/{e}")]


def corrections(spark: SparkSession, warehouse: Warehouse, entity: str) -> DataFrame:
    """(source_file, malformed_record, corrected): the last correction of each line of an entity."""
    notes = read_table(spark, warehouse.corrections, _CORRECTIONS).where(F.col("entity") == entity)
    return notes.groupBy("source_file", lz.MALFORMED).agg(F.max_by("corrected", F.struct("replay_id", "corrected")).alias("corrected"))


def _corrected(spark: SparkSession, warehouse: Warehouse, entity: str, scanned: DataFrame, days: list[dt.date] | None = None) -> DataFrame:
    if not exists(spark, f"{warehouse.corrections}/entity={entity}"):
        return scanned
    known = corrections(spark, warehouse, entity)
    if days is not None:
        known = known.where(lz.batch_date(F.col("source_file")).isin(days))
    return scanned if known.isEmpty() else lz.apply_corrections(scanned, known, entity)


def replay(spark: SparkSession, landing: str, warehouse: Warehouse, fixes: DataFrame, entity: str = "orders") -> list[dt.date]:
    """Take quarantined lines in again as ``corrected``; returns the days that were rebuilt.

    ``fixes`` has source_file, malformed_record and corrected, as ``quarantined_lines`` gives
    the first two.  Corrections are noted before anything is rebuilt, and every later rebuild
    applies them, so a replay that is repeated, or that dies half way, ends the same.  The last
    correction of a line counts; NULL takes it back.  Lines that no file has are noted only.
    """
    noted = fixes.select("source_file", lz.MALFORMED, "corrected", F.lit(entity).alias("entity"), F.lit(f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}").alias("replay_id"))
    # Stored first: the lines may come from the table that is rebuilt.
    noted.write.mode("append").partitionBy("entity", "replay_id").parquet(warehouse.corrections)
    if entity != "orders":
        load_dimensions(spark, landing, warehouse)
        return []
    files = corrections(spark, warehouse, entity).select(lz.batch_date(F.col("source_file")).alias("batch_date"))
    days = sorted(r.batch_date for r in files.where("batch_date is not null").distinct().collect())
    if days:
        rebuild_days(spark, landing, warehouse, days)
    return days


def load_dimensions(spark: SparkSession, landing: str, warehouse: Warehouse) -> None:
    """Replace the dimension tables from their landing files; one that is not landed stays."""
    for entity in landed_dimensions(spark, landing):
        scanned = lz.scan_landing(spark, landing, entity)
        write_dimension(_corrected(spark, warehouse, entity, scanned), warehouse.dimension(entity))


def rebuild_days(spark: SparkSession, landing: str, warehouse: Warehouse, days: list[dt.date]) -> None:
    """Rewrite the raw partitions of ``days`` from their landing files, good and bad rows alike."""
    scanned = lz.scan_batches(spark, landing, days)
    write_daily(_corrected(spark, warehouse, "orders", scanned, days), warehouse.orders)


def _days(files: DataFrame) -> list[dt.date]:
    """The batch dates of some files: one per calendar day, from file names alone."""
    days = [r.batch_date for r in files.select("batch_date").distinct().collect()]
    if None in days:
        raise UndatedFileError(f"no batch date in {files.where('batch_date is null').first().path}")
    return days


def _record(files: DataFrame, warehouse: Warehouse, load_id: str) -> None:
    """Note the files' versions; writing the same load again replaces its notes."""
    (
        files.withColumn("load_id", F.lit(load_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id")
        .parquet(warehouse.files)
    )


def _on_new_files(landing: str, warehouse: Warehouse, rebuilt: set[dt.date]):
    def handle(files: DataFrame, batch_id: int) -> None:
        days = _days(files)
        if days:
            # Before reading: a file rewritten meanwhile is then newer than its note.
            _record(files, warehouse, f"batch-{batch_id}")
            rebuild_days(files.sparkSession, landing, warehouse, days)
            rebuilt.update(days)

    return handle


def load_new_orders(
    spark: SparkSession, landing: str, warehouse: Warehouse, max_files_per_trigger: int | None = None
) -> set[dt.date]:
    """Load the order files that were not loaded before, and end; returns the days that were rebuilt."""
    rebuilt: set[dt.date] = set()
    if not exists(spark, f"{landing}/orders"):
        return rebuilt
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .options(recursiveFileLookup=True, pathGlobFilter="*.csv")
        .option("maxFileAge", MAX_FILE_AGE)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(f"{landing}/orders").select("path", "modificationTime", "length")
    query = (
        files.withColumn("batch_date", lz.batch_date(F.col("path")))
        .writeStream.foreachBatch(_on_new_files(landing, warehouse, rebuilt))
        .option("checkpointLocation", warehouse.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return rebuilt


def files_gone(spark: SparkSession, landing: str, warehouse: Warehouse) -> DataFrame | None:
    """(path, batch_date) of the files that the ledger holds though they are gone, stored as of now; None before the first load."""
    if not exists(spark, f"{landing}/orders") or not exists(spark, warehouse.files):
        return None
    ledger = read_table(spark, warehouse.files, _LEDGER)
    return materialise(lz.removed_files(lz.file_inventory(spark, landing), ledger), f"{warehouse.ledger}/gone")


def load_missed_orders(
    spark: SparkSession, landing: str, warehouse: Warehouse, before: DataFrame | None = None, rebuilt: set[dt.date] = frozenset()
) -> None:
    """Rebuild the days of files that the ledger lacks, holds in another version, or holds though they are gone.

    These are the files rewritten under their name, those too old for the stream, and those that
    were removed or renamed.  A day none of whose files is left was moved out of the landing
    zone as a whole, and stays as it was loaded.

    ``rebuilt`` are days that this load has rebuilt already, and ``before`` the files that were gone when it
    began (:func:`files_gone`): the days are without these, and are not rebuilt again on their account.
    """
    if not exists(spark, f"{landing}/orders"):
        return
    ledger = read_table(spark, warehouse.files, _LEDGER)
    # Names and times as of now, stored before any of the files is read.
    inventory = lz.file_inventory(spark, landing)
    missed = materialise(lz.new_files(inventory, ledger), f"{warehouse.ledger}/missed")
    gone = materialise(lz.removed_files(inventory, ledger), f"{warehouse.ledger}/removed")
    removed = _days(gone)
    left = gone if before is None else gone.join(before.where(F.col("batch_date").isin(list(rebuilt))), "path", "left_anti")
    days = sorted({*_days(missed), *_days(left)})
    if days:
        rebuild_days(spark, landing, warehouse, days)
        _record(missed, warehouse, f"change-{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}")
    if removed:
        # Last: a load that dies before finds them again.
        compact_ledger(spark, warehouse, 0, gone)


def compact_ledger(spark: SparkSession, warehouse: Warehouse, max_notes: int = MAX_NOTES, without: DataFrame | None = None) -> bool:
    """Merge the ledger's notes into one folder with the last version of each file, ``without`` some.

    The merged notes are written before the others go; a crash in between leaves notes twice,
    which changes nothing.
    """
    if not exists(spark, warehouse.files):
        return False
    fs, root = hadoop_path(spark, warehouse.files)
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("load_id=")]
    if len(old) <= max_notes:
        return False
    notes = read_table(spark, warehouse.files, _LEDGER)
    latest = notes.groupBy("path").agg(F.max_by(F.struct("modificationTime", "length", "batch_date"), "modificationTime").alias("_v"))
    if without is not None:
        latest = latest.join(without.select("path"), "path", "left_anti")
    _record(latest.select("path", "_v.*"), warehouse, f"merged-{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}")
    for path in old:
        fs.delete(path, True)
    return True


def run_load(spark: SparkSession, landing: str, warehouse: Warehouse | str, mode: str = "incremental") -> None:
    """Load the landing zone: ``full`` empties the raw tables first, ``incremental`` adds.

    A full load needs both dimensions in the landing zone, and looks before it deletes.
    It drops the ledger before the table: whatever step it dies in, the next load of
    either mode sees all files as new and finishes the job.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"unknown load mode: {mode}")
    warehouse = Warehouse(warehouse) if isinstance(warehouse, str) else warehouse
    if mode == "full":
        missing = set(DIMENSIONS) - set(landed_dimensions(spark, landing))
        if missing:
            raise MissingDimensionError(f"not landed: {', '.join(sorted(missing))}")
        _delete(spark, warehouse.ledger)
        _delete(spark, warehouse.orders)
    load_dimensions(spark, landing, warehouse)
    before = files_gone(spark, landing, warehouse)
    rebuilt = load_new_orders(spark, landing, warehouse)
    load_missed_orders(spark, landing, warehouse, before, rebuilt)
    compact_ledger(spark, warehouse)


def raw_order_batches(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Raw orders as loaded: good and malformed rows with source file and batch date."""
    return read_table(spark, warehouse.orders, _RAW_BATCHES)


def raw_orders(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Good raw orders with their ``batch_date`` and the ``row_id`` used to spread hot keys."""
    if not exists(spark, warehouse.orders):
        empty = T.StructType([*RAW_ORDERS.fields, T.StructField("batch_date", T.DateType())])
        return spark.createDataFrame([], empty)
    good = spark.read.schema(_RAW_BATCHES).parquet(warehouse.orders).where(F.col(lz.MALFORMED).isNull())
    return good.select(*RAW_ORDERS.names, "batch_date", row_identity())


def raw_order_ids(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The order ids of the good rows alone, without the columns that tell rows apart."""
    return raw_order_batches(spark, warehouse).where(F.col(lz.MALFORMED).isNull()).select("order_id")


def raw_dimension_lines(spark: SparkSession, warehouse: Warehouse, entity: str) -> DataFrame:
    """A dimension as loaded: good and malformed rows with source file."""
    lines = [T.StructField(c, T.StringType()) for c in (lz.MALFORMED, "source_file")]
    return read_table(spark, warehouse.dimension(entity), T.StructType([*RAW[entity].fields, *lines]))


def raw_dimension(spark: SparkSession, warehouse: Warehouse, entity: str) -> DataFrame:
    return lz.good_rows(raw_dimension_lines(spark, warehouse, entity))


def loaded_counts(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """(table_name, cnt) of the three raw tables, to check a load."""
    return load_row_counts(
        {
            "Customers": raw_dimension(spark, warehouse, "customers"),
            "Products": raw_dimension(spark, warehouse, "products"),
            "Orders": raw_orders(spark, warehouse),
        }
    )


def _loaded_lines(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """(entity, source_file, batch_date, malformed_record) of every line of the three raw tables."""
    orders = raw_order_batches(spark, warehouse).select("source_file", "batch_date", lz.MALFORMED)
    parts = [orders.select(F.lit("orders").alias("entity"), "*")]
    for entity in DIMENSIONS:
        lines = raw_dimension_lines(spark, warehouse, entity)
        undated = F.lit(None).cast("date").alias("batch_date")
        parts.append(lines.select(F.lit(entity).alias("entity"), "source_file", undated, lz.MALFORMED))
    return reduce(DataFrame.unionByName, parts)


def quarantined_lines(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Malformed lines of all entities with their file and, for orders, batch date."""
    return _loaded_lines(spark, warehouse).where(F.col(lz.MALFORMED).isNotNull())


def load_report(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Per loaded file: lines that parsed, lines rejected, and a rejected line (the smallest as text)."""
    rejected = F.col(lz.MALFORMED).isNotNull()
    return (
        _loaded_lines(spark, warehouse)
        .groupBy("entity", "source_file", "batch_date")
        .agg(
            F.count_if(~rejected).alias("row_count"),
            F.count_if(rejected).alias("rejected"),
            F.min(lz.MALFORMED).alias("first_error"),
        )
    )
