"""Reading and writing warehouse tables, and the snapshot of the report feed."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trustline.sources.schemas import FEED


#: Blanks, quotes and backslashes come back as they were written; quotes in a field are doubled.
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

#: Stored rows. Not for dimensions: Spark takes the size of their files for theirs when it chooses what to broadcast.
PARQUET = {"compression": "zstd"}


#: Spark's setting that drops what an execution has dealt when it ends.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class MissingDimensionError(RuntimeError):
    """A dimension table that orders refer to has not been loaded."""


def row_identity() -> Column:
    """A number that is the same for a stored Parquet row on every read and retry.

    Only used to spread rows, so two rows may share it.
    """
    return F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row_id")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path``, whatever store it is on."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared storage that ``spark.checkpoint.dir`` names.

    Where that is unset it is a local one, which only a local master's tasks can share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "local")
    if not shared and not (master == "local" or master.startswith("local[")):  # not local-cluster
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if shared:
        return f"{shared.rstrip('/')}/trustline-{name}-{uuid.uuid4().hex}"
    return tempfile.mkdtemp(prefix=f"trustline-{name}-")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table; an empty frame of ``schema`` when it was never written."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def require_dimensions(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read the named dimension tables, failing when one is missing."""
    missing = [name for name, path in paths.items() if not exists(spark, path)]
    if missing:
        raise MissingDimensionError(f"dimension not loaded: {', '.join(sorted(missing))}")
    return {name: spark.read.parquet(path) for name, path in paths.items()}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run inside drops the rows it has dealt from the executors' disks when it ends.

    Else they lie there until the driver collects its garbage, beside those of the next steps.  For
    writes, and for frames made inside: one that is run again deals its rows again.
    """
    before = spark.conf.get(FREE, None)
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE) if before is None else spark.conf.set(FREE, before)


def write_dimension(df: DataFrame, path: str) -> None:
    """Replace a dimension table."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def write_daily(
    df: DataFrame, path: str, fmt: str = "parquet", cluster: bool = False, **options: str
) -> None:
    """Write one partition per ``batch_date``; a rerun replaces the dates it holds.

    ``cluster`` gathers each date first, which keeps the file count near the number of
    dates where every task holds rows of many; AQE splits a date that is far larger
    than the others.  Rows that come from one file per date need no such shuffle.
    """
    rows = df.hint("rebalance", "batch_date") if cluster else df
    with shuffles_freed(df.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**(PARQUET if fmt == "parquet" else {}) | options)
            .partitionBy("batch_date")
            .format(fmt)
            .save(path)
        )


def materialise(df: DataFrame, target: str, as_table: bool = False) -> DataFrame:
    """Write ``df`` as a full rebuild and return the stored table.

    Downstream work reads the files instead of repeating the joins, and a lost
    executor costs no recomputation.
    """
    spark = df.sparkSession
    if as_table:
        with shuffles_freed(spark):
            df.write.mode("overwrite").options(**PARQUET).format("parquet").saveAsTable(target)
        return spark.table(target)
    with shuffles_freed(spark):
        df.write.mode("overwrite").options(**PARQUET).parquet(target)
    return spark.read.parquet(target)


def create_views(frames: dict[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their names, without storing them."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def export_snapshot(feed: DataFrame, path: str, single_file: bool = False) -> None:
    """Write the feed as a directory of CSV files with headers.

    ``single_file`` is for consumers that read one file; it takes the feed through one task.
    """
    rows = feed.coalesce(1) if single_file else feed.hint("rebalance")
    with shuffles_freed(feed.sparkSession):
        rows.write.mode("overwrite").options(header=True, **CSV).csv(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The exported feed; an empty frame when there is none."""
    if not exists(spark, path):
        return spark.createDataFrame([], FEED)
    # A status may hold line breaks; the feed's files are small enough not to be split.
    return spark.read.schema(FEED).options(header=True, multiLine=True, **CSV).csv(path)
