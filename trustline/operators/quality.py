"""Declarative column tests, their results, the pipeline gate and failing rows."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustline.functions import flags
from trustline.sources.schemas import DQ_RESULTS
from trustline.sources.tables import shuffles_freed


@dataclass(frozen=True)
class ColumnTest:
    """A test of one column.  ``warn_if`` and ``error_if`` are conditions on the failure count.

    With severity ``error`` a test fails when ``error_if`` holds and else warns when
    ``warn_if`` holds.  With severity ``warn`` it can only warn: problems are to be
    shown, not to stop the pipeline.
    """

    model: str
    column: str
    severity: str = "error"
    warn_if: str = "> 0"
    error_if: str = "> 0"

    kind = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"

    def status(self) -> Column:
        warned = F.when(F.expr(f"failures {self.warn_if}"), "warn").otherwise("pass")
        if self.severity == "warn":
            return warned
        return F.when(F.expr(f"failures {self.error_if}"), "fail").otherwise(warned)


@dataclass(frozen=True)
class RowTest(ColumnTest):
    """A test that looks at each row alone: all of a table's run in one aggregate."""

    def broken(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowTest):
    kind = "not_null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between(RowTest):
    """Known values within [lo, hi]; an open end is None."""

    lo: float | None = None
    hi: float | None = None
    kind = "between"

    def broken(self) -> Column:
        outside = [F.col(self.column) < self.lo] if self.lo is not None else []
        outside += [F.col(self.column) > self.hi] if self.hi is not None else []
        return reduce(lambda a, b: a | b, outside, F.lit(False))


@dataclass(frozen=True)
class Unique(ColumnTest):
    """Counts known key values that occur more than once."""

    kind = "unique"


@dataclass(frozen=True)
class Relationship(ColumnTest):
    """Counts rows whose known value has no match in the parent table."""

    parent: str = ""
    parent_column: str = ""
    kind = "relationships"

    def failures(self, tables: dict[str, DataFrame]) -> DataFrame:
        # Children are counted per key before the join: a hot key is one row by then.
        children = (
            tables[self.model]
            .where(F.col(self.column).isNotNull())
            .groupBy(F.col(self.column).alias("_child"))
            .agg(F.count("*").alias("_n"))
        )
        parents = tables[self.parent].select(F.col(self.parent_column).alias("_parent"))
        orphans = children.join(parents, F.col("_child") == F.col("_parent"), "left_anti")
        return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


# The tests of the order models.
ORDER_TESTS: list[ColumnTest] = [
    Unique("stg_customers", "customer_id"),
    NotNull("stg_customers", "customer_id"),
    Unique("stg_products", "product_id"),
    NotNull("stg_products", "product_id"),
    Unique("stg_orders", "order_id", severity="warn"),
    NotNull("stg_orders", "order_id"),
    Unique("fct_orders", "order_id", severity="warn"),
    NotNull("fct_orders", "order_id"),
    Relationship(
        "fct_orders",
        "customer_id",
        severity="warn",
        warn_if="> 0",
        error_if="> 1000",
        parent="stg_customers",
        parent_column="customer_id",
    ),
    Between("fct_orders", "total_amount", severity="warn", lo=0),
]


class PipelineGateError(RuntimeError):
    """A test failed; the steps after the tests must not run."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Known key values with more than one row, and how many rows each has."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def _counted(table: DataFrame, key: Unique | None, tests: list[RowTest]) -> DataFrame:
    """One row, one column per test: all from one scan of the table.

    With a key the rows are counted per key value first, map-side combined, and the row tests
    ride along; a hot key or the NULL group is one row after that.
    """
    broken = [F.count_if(t.broken()).alias(f"_{i}") for i, t in enumerate(tests)]
    if key is None:
        return table.agg(*broken)
    per_key = table.groupBy(F.col(key.column).alias("_key")).agg(F.count("*").alias("_n"), *broken)
    repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias(f"_{len(tests)}")
    return per_key.agg(*[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(tests))], repeated)


def _result(failures: DataFrame, test: ColumnTest) -> DataFrame:
    return failures.select(
        F.lit(test.name).alias("test_name"),
        F.lit(test.model).alias("model"),
        F.lit(test.column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
        F.lit(test.severity).alias("severity"),
        test.status().alias("status"),
    )


def _table_results(table: DataFrame, key: Unique | None, tests: list[RowTest]) -> DataFrame:
    """Results of a table's row tests and of one uniqueness test."""
    specs: list[ColumnTest] = [*tests, *([key] if key else [])]
    pairs = [F.struct(F.lit(i).alias("_test"), F.col(f"_{i}").alias("failures")) for i in range(len(specs))]
    failures = _counted(table, key, tests).select(F.inline(F.array(*pairs)))

    def pick(value) -> Column:
        return F.coalesce(*[F.when(F.col("_test") == i, value(t)) for i, t in enumerate(specs)])

    return failures.select(
        pick(lambda t: F.lit(t.name)).alias("test_name"),
        pick(lambda t: F.lit(t.model)).alias("model"),
        pick(lambda t: F.lit(t.column)).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
        pick(lambda t: F.lit(t.severity)).alias("severity"),
        pick(lambda t: t.status()).alias("status"),
    )


def run_tests(
    tables: dict[str, DataFrame],
    specs: list[ColumnTest] | None = None,
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """One result row per test: a lazy union of one plan per table, key and relationship.

    A table's row tests share the scan of its first uniqueness test.
    """
    specs = ORDER_TESTS if specs is None else specs
    rows: dict[str, list[RowTest]] = defaultdict(list)
    keys: dict[str, list[Unique]] = defaultdict(list)
    parts = []
    for spec in specs:
        if isinstance(spec, RowTest):
            rows[spec.model].append(spec)
        elif isinstance(spec, Unique):
            keys[spec.model].append(spec)
        else:
            parts.append(_result(spec.failures(tables), spec))
    for model in dict.fromkeys([*rows, *keys]):
        first, *others = keys[model] or [None]
        parts.append(_table_results(tables[model], first, rows[model]))
        parts += [_table_results(tables[model], key, []) for key in others]
    results = reduce(DataFrame.unionByName, parts)
    stamp = F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")
    return results.withColumn("generated_at", stamp).select(*DQ_RESULTS.names)


def failed_results(results: DataFrame) -> DataFrame:
    return results.where(F.col("status").isin("fail", "warn"))


def dq_failure_summary(results: DataFrame) -> DataFrame:
    """Earliest run time and number of results that failed or warned."""
    return failed_results(results).agg(
        F.min("generated_at").alias("test_run_time"), F.count("*").alias("total_failures")
    )


def log_results(results: DataFrame, path: str) -> DataFrame:
    """Append a run's results to the log, and return the run's rows as stored.

    The results are a handful of rows; collecting them runs each test exactly once,
    for the log and for the gate.
    """
    spark = results.sparkSession
    with shuffles_freed(spark):
        run = spark.createDataFrame(results.select("*").collect(), DQ_RESULTS)
    run.coalesce(1).write.mode("append").parquet(path)
    return run


def require_no_failures(results: DataFrame) -> None:
    """The gate: raise when any test has status ``fail``; warnings pass."""
    failed = [r.test_name for r in results.where("status = 'fail'").select("test_name").collect()]
    if failed:
        raise PipelineGateError("failed: " + ", ".join(sorted(failed)))


def quarantine_rows(fct: DataFrame) -> DataFrame:
    """Dirty rows with the names of the flags each carries."""
    return fct.where(flags.dirty()).withColumn("reasons", flags.reasons())


def quarantine_by_reason(fct: DataFrame) -> DataFrame:
    """Rows and amount per flag that occurs; a row counts once for each of its flags."""
    totals = fct.agg(
        *[F.count_if(F.col(f)).alias(f"{f}_n") for f in flags.FLAGS],
        *[F.sum(F.when(F.col(f), F.col("total_amount"))).alias(f"{f}_amount") for f in flags.FLAGS],
    )
    rows = [
        F.struct(
            F.lit(f).alias("reason"),
            F.col(f"{f}_n").alias("row_count"),
            F.col(f"{f}_amount").alias("amount"),
        )
        for f in flags.FLAGS
    ]
    return totals.select(F.inline(F.array(*rows))).where(F.col("row_count") > 0)
