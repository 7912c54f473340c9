"""Compare every registered query with its SQL counterpart in DuckDB.

Usage: python tests/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, columns):
    """Rows as sorted tuples of text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return repr(v + 0.0)
        return repr(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(spark, con, build, sql, sf_dir):
    """(equal, spark row count, message)."""
    df = build(spark, sf_dir)
    mine = normal(df.collect(), df.columns)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = normal(cur.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return False, len(mine), f"columns {sorted(df.columns)} != {sorted(columns)}"
    if mine != theirs:
        diff = [p for p in zip(mine, theirs) if p[0] != p[1]][:2]
        return False, len(mine), f"{len(mine)} vs {len(theirs)} rows; {diff}"
    return True, len(mine), ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from trustline import spark_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = spark_session(
        master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, build in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            ok, n, why = compare(spark, con, build, oracles[name], sf_dir)
        except Exception as e:  # show and go on with the next query
            ok, n, why = False, -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {n:8d} {time.time() - start:6.2f}s {why}", flush=True)
    print(f"{bad} failures")
    sys.exit(bool(bad))
