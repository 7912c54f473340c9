"""Landing files: CSV with a header, one directory per entity, loaded as text.

Order files carry their batch date in the path, either ``orders_2024-01-31.csv`` or
``batch_date=2024-01-31/part-...csv``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustline.functions.casts import normalise_null_markers
from trustline.sources import records
from trustline.sources.schemas import RAW
from trustline.sources.tables import CSV, exists, hadoop_path, shuffles_freed, write_daily

MALFORMED = "malformed_record"
# Names of files with open lines that are broadcast; more of them are joined.
FEW_FILES = 10_000
_DAY = r"(\d{4}-\d{2}-\d{2})"
BATCH_DATE = rf"(?:orders_|batch_date=){_DAY}"


def batch_date(path: Column) -> Column:
    """The batch date named in a file path, NULL when it names none."""
    # Scans ask for it in every row: a pattern that begins with a text is found far sooner than one of two.
    # Nothing found is no date.
    folder = F.regexp_extract(path, f"batch_date={_DAY}", 1)
    return F.when(path.contains("orders_"), F.regexp_extract(path, BATCH_DATE, 1)).otherwise(folder).try_cast("date")


def scan_landing(spark: SparkSession, landing: str, entity: str, quote: str = '"', days: list[dt.date] | None = None) -> DataFrame:
    """All rows of an entity's files: text columns, the malformed record if any, source file.

    Columns bind by position.  A record with too few or too many fields, or with a quote that is
    never closed, is kept whole in ``malformed_record`` instead of failing the load.  ``quote=""``
    turns quoting off; else a first pass looks for files in which a quoted field goes on after a
    line's end, and these are put together from their lines (:mod:`records`).  With ``days`` only
    files whose path names one of them are opened.
    """
    names = RAW[entity].names
    path = f"{landing}/{entity}"
    rows = _single_lines(spark, path, entity, quote)
    wanted = None if days is None else lambda file: batch_date(file).isin(days)
    if wanted:
        rows = rows.where(wanted(F.col("source_file")))
    if quote:
        lines = records.read_lines(spark, path, wanted)
        open_files = records.files_with_open_lines(records.read_lines(spark, path, wanted, quote), quote)
        found = [tuple(r) for r in open_files.limit(FEW_FILES + 1).collect()]
        if found:
            few = len(found) <= FEW_FILES
            size = sum(length for _, length in found) if few else open_files.agg(F.sum("size")).first()[0]
            tasks = records.tasks_for(size)
            if few:
                # Lines carry the number of their file instead of its path.
                files = F.broadcast(spark.createDataFrame([(file, n) for n, (file, _) in enumerate(found)], "path string, number int"))
                numbered = lines.join(files, F.col("file") == F.col("path")).drop("file", "path").withColumnRenamed("number", "file")
                whole = _assembled(numbered, entity, quote, tasks).join(files, F.col("source_file") == F.col("number"))
                whole = whole.drop("source_file", "number").withColumnRenamed("path", "source_file")
            else:
                files = open_files.withColumnRenamed("file", "path")
                whole = _assembled(lines.join(files, F.col("file") == F.col("path"), "left_semi"), entity, quote, tasks)
            rows = rows.join(files, F.col("source_file") == F.col("path"), "left_anti").unionByName(whole)
    return normalise_null_markers(rows, names)


def _schema_of(entity: str) -> T.StructType:
    return T.StructType([*RAW[entity].fields, T.StructField(MALFORMED, T.StringType())])


def _options(quote: str) -> dict[str, str]:
    # Fields of a line are counted whatever columns are used.
    return {"quote": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false", **CSV}


def _single_lines(spark: SparkSession, path: str, entity: str, quote: str) -> DataFrame:
    names = RAW[entity].names
    # Spark refuses a scan of nothing but the malformed line, so let it depend on one more
    # column; the condition always holds.
    always = F.coalesce(F.length(names[0]), F.lit(0)) >= 0
    malformed = F.when(always, F.col(MALFORMED))
    files = spark.read.schema(_schema_of(entity)).options(header=True, enforceSchema=True, recursiveFileLookup=True, pathGlobFilter="*.csv", **_options(quote))
    return files.csv(path).select(*names, malformed.alias(MALFORMED), F.col("_metadata.file_path").alias("source_file"))


def _parsed(text: Column, entity: str, quote: str) -> Column:
    """The fields of a whole record, and the record itself as malformed if it doesn't parse."""
    schema = _schema_of(entity).simpleString()[len("struct<") : -1].replace(":", " ")
    return F.from_csv(text, schema, {**_options(quote), "multiLine": "true"})


def _assembled(lines: DataFrame, entity: str, quote: str, tasks: int) -> DataFrame:
    names = RAW[entity].names
    found = records.assemble(lines, quote, tasks=tasks).where((F.col("record") > 1) & (F.trim("value") != ""))
    read = found.withColumn("fields", F.when(~F.col("unclosed"), _parsed(F.col("value"), entity, quote)))
    bad = F.when(F.col("unclosed"), F.col("value")).otherwise(F.col(f"fields.{MALFORMED}"))
    return read.select(*[F.col(f"fields.{c}").alias(c) for c in names], bad.alias(MALFORMED), F.col("file").alias("source_file"))


def good_rows(scanned: DataFrame) -> DataFrame:
    """Rows that parsed, without the bookkeeping columns."""
    return scanned.where(F.col(MALFORMED).isNull()).drop(MALFORMED, "source_file")


def malformed_rows(scanned: DataFrame) -> DataFrame:
    """(source_file, malformed_record[, batch_date]) of the lines that did not parse."""
    kept = [c for c in ("source_file", MALFORMED, "batch_date") if c in scanned.columns]
    return scanned.where(F.col(MALFORMED).isNotNull()).select(*kept)


def apply_corrections(scanned: DataFrame, corrections: DataFrame, entity: str, quote: str = '"') -> DataFrame:
    """``scanned`` with malformed records replaced by what ``corrections`` has for their file and text.

    A correction that doesn't parse, leaves a quote open or is NULL changes nothing.  Equal
    records of a file share a correction.  Only the malformed rows are joined.
    """
    names = RAW[entity].names
    fixes = corrections.select(F.col("source_file").alias("_file"), F.col(MALFORMED).alias("_line"), F.col("corrected").alias("_text"))
    bad = scanned.where(F.col(MALFORMED).isNotNull())
    known = bad.join(fixes, (F.col("source_file") == F.col("_file")) & (F.col(MALFORMED) == F.col("_line")), "left")
    known = known.withColumn("_fields", _parsed(F.col("_text"), entity, quote))
    closed = ~records.opens(F.col("_text"), quote) if quote else F.lit(True)
    parses = (F.trim("_text") != "") & closed & F.col(f"_fields.{MALFORMED}").isNull()
    known = known.withColumn("_parses", F.coalesce(parses, F.lit(False)))
    values = {c: F.when(F.col("_parses"), F.col(f"_fields.{c}")) for c in names}
    values[MALFORMED] = F.when(~F.col("_parses"), F.col(MALFORMED))
    fixed = normalise_null_markers(known.withColumns(values), names).select(*scanned.columns)
    return scanned.where(F.col(MALFORMED).isNull()).unionByName(fixed)


def scan_batches(spark: SparkSession, landing: str, days: list[dt.date] | None = None) -> DataFrame:
    """Order files with their ``batch_date``, of ``days`` only when given.

    The day filter is on the file path, so files of other days are not opened.
    """
    day = batch_date(F.col("source_file"))
    return scan_landing(spark, landing, "orders", days=days).withColumn("batch_date", day)


def file_inventory(spark: SparkSession, landing: str, entity: str = "orders") -> DataFrame:
    """(path, modificationTime, length, batch_date) of an entity's files; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.csv")
        .load(f"{landing}/{entity}")
        .select("path", "modificationTime", "length")
    )
    return files.withColumn("batch_date", batch_date(F.col("path")))


def new_files(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of the inventory that the ledger lacks or holds in an older version."""
    return inventory.join(ledger.select("path", "modificationTime"), ["path", "modificationTime"], "left_anti")


def removed_files(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path, batch_date) of files in the ledger that the inventory lacks, of days that still have files."""
    gone = ledger.select("path", "batch_date").distinct().join(inventory.select("path"), "path", "left_anti")
    return gone.join(inventory.select("batch_date").distinct(), "batch_date", "left_semi").select("path", "batch_date")


def headers(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """Per file of an entity: its header line, the columns it misses, has besides, and whether their order is another.

    Columns bind by position, so a file whose header drifts may be loaded with its values exchanged.
    """
    declared = F.array(*[F.lit(c) for c in RAW[entity].names])
    lines = records.read_lines(spark, f"{landing}/{entity}").where(F.col("block") == 0)
    first = lines.groupBy(F.col("file").alias("source_file")).agg(F.min_by("value", "nth").alias("header"))
    plain = F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), "\r$", "")
    names = F.transform(F.split(plain, ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '^"|"$', ""))))
    found = first.select("source_file", batch_date(F.col("source_file")).alias("batch_date"), plain.alias("header"), names.alias("_found"))
    missing, extra = F.array_except(declared, F.col("_found")), F.array_except(F.col("_found"), declared)
    moved = (F.size(missing) == 0) & (F.size(extra) == 0) & (F.col("_found") != declared)
    status = F.when(F.col("_found") == declared, "ok").when(moved, "moved").otherwise("renamed")
    listed = [F.array_join(F.array_sort(c), ",").alias(n) for c, n in ((missing, "missing"), (extra, "extra"))]
    return found.select("source_file", "batch_date", "header", *listed, status.alias("status"))


def land_batches(orders: DataFrame, landing: str) -> None:
    """Write order rows as CSV, one directory per ``batch_date``; a rerun replaces its days.

    Line breaks in fields are written as they are, in quotes; the scan puts such rows together.
    """
    rows = orders.select(*RAW["orders"].names, "batch_date")
    write_daily(rows, f"{landing}/orders", "csv", cluster=True, header="true", **CSV)


def land_dimension(df: DataFrame, landing: str, entity: str) -> None:
    """Replace a dimension's landing files."""
    with shuffles_freed(df.sparkSession):
        df.select(*RAW[entity].names).write.mode("overwrite").options(header=True, **CSV).csv(f"{landing}/{entity}")


def reset_landing(spark: SparkSession, path: str) -> bool:
    """Delete the landing folder and all below it.  Refuses an empty path and a root."""
    if not path or not path.strip():
        raise ValueError("refusing to reset an empty path")
    fs, target = hadoop_path(spark, path)
    if target.isRoot() or target.getParent() is None:
        raise ValueError(f"refusing to reset a root: {path}")
    return exists(spark, path) and fs.delete(target, True)
