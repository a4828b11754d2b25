"""Compare check queries with their SQL run by DuckDB on the same tables.

``python tests/oracle.py [sf_dir] [name ...]`` compares from the command line.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, query, sql: str, sf_dir: str) -> tuple[list[str], int]:
    """What differs (column names, or rows of one side only), and the number of rows. Values must be equal exactly."""
    got = query(spark, sf_dir)
    got_rows = got.collect()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(got.columns):
        return [f"columns {sorted(got.columns)} != {sorted(columns)}"], len(got_rows)
    want = _rows(columns, cursor.fetchall())
    have = _rows(got.columns, got_rows)
    problems = [f"only in Spark: {r}" for r in list((have - want))[:3]]
    problems += [f"only in SQL:   {r}" for r in list((want - have))[:3]]
    return problems, len(got_rows)


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as spark_entry
    from macrolake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    queries, oracle = spark_entry.queries(), spark_entry.oracle_sql()
    for name in argv[1:] or queries:
        start = time.time()
        try:
            if name not in oracle:
                print(f"----  {name}: {queries[name](spark, sf_dir).count()} rows, no SQL", flush=True)
                continue
            problems, n = differences(spark, con, queries[name], oracle[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problems, n = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '}  {name}: {n} rows, {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("      ", p)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
