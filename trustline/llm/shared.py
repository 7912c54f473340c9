"""Storage that driver and executors share."""

from __future__ import annotations

import ctypes
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustline.sources.tables import scratch_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``; a local one only where that is unset and the master is local."""
    return scratch_folder(spark, f"llm-{name}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to shared storage and read it back.

    A lost executor then costs its own tasks only, and nothing before them is repeated.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark, name)}/{uuid.uuid4().hex[:8]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _trim() -> None:
    """Give freed memory back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(spark: SparkSession) -> None:
    """Between the steps of a long chain: the driver collects its garbage now.

    Plans, task results, broadcasts and shuffle files of finished steps go, and the heap shrinks
    before the next step's plans are made, instead of growing to its limit first.
    """
    spark.sparkContext._jvm.System.gc()
    _trim()


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has; the user sets it to suit the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(value: Column, cuts: list, kind: str) -> Column:
    """How many of the sorted ``cuts`` are at or below ``value``, by bisection."""
    if not cuts:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(cuts)), f"array<{kind}>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, F.least(at + step, F.lit(len(cuts))) - 1) <= value), at + step).otherwise(at)
    )


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving freed memory back when it ends: workers wait for further tasks, and several wait beside those that run."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _trim()

    return lean_run
