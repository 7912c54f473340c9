"""Every registered query against DuckDB on the smallest test tables."""

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from trustline.plans.catalog import QUERIES as CORE


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_equals_sql(spark, duck, sf, name):
    ok, rows, why = compare(spark, duck, queries()[name], oracle_sql()[name], sf)
    assert ok, why
    assert rows > 0


def test_every_query_has_sql():
    assert set(CORE) <= set(queries()) and set(CORE) <= set(oracle_sql())


def test_entry_is_the_rollup(spark):
    assert entry(spark).columns[:3] == ["order_date", "status", "order_count"]
