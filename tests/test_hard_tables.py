"""All kinds of registered queries on hostile tables: hot keys, gaps, repeated days, odd texts."""

import datetime as dt
import random

import oracle
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from macrolake.plans import check_layers, check_reads, check_sources  # noqa: F401
from macrolake.plans.registry import ORACLE_SQL, QUERIES

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def some_day(rng, hot):
    """A third of the rows on one day, none in two long gaps."""
    if rng.random() < 0.34:
        return hot
    while True:
        day = dt.datetime(1995, 1, 1) + dt.timedelta(rng.randrange(2300))
        if not (dt.datetime(1996, 3, 1) <= day < dt.datetime(1997, 6, 1) or day.year == 1999):
            return day


def orders(rng, n):
    rows = {
        "o_orderkey": rng.sample(range(10**6), n),
        "o_custkey": [7 if rng.random() < 0.4 else rng.randrange(60) for _ in range(n)],
        "o_orderstatus": [rng.choice("FFFFOP") for _ in range(n)],
        "o_totalprice": [rng.randrange(100, 50_000_000) / 100 for _ in range(n)],
        "o_orderdate": [some_day(rng, dt.datetime(1998, 2, 28)) for _ in range(n)],
        "o_orderpriority": [rng.choice(PRIORITIES) if rng.random() < 0.6 else "2-HIGH" for _ in range(n)],
    }
    return pa.table(rows, schema=oracle_schema("orders"))


def lineitem(rng, n):
    rows = {
        "l_orderkey": [rng.randrange(500) for _ in range(n)],
        "l_partkey": [rng.randrange(50) for _ in range(n)],
        "l_suppkey": [3 if rng.random() < 0.5 else rng.randrange(6) for _ in range(n)],
        "l_linenumber": [rng.randrange(1, 8) for _ in range(n)],
        "l_quantity": [float(rng.randrange(1, 51)) for _ in range(n)],
        "l_extendedprice": [rng.randrange(100, 10_000_000) / 100 for _ in range(n)],
        "l_discount": [rng.randrange(0, 11) / 100 for _ in range(n)],
        "l_tax": [rng.randrange(0, 9) / 100 for _ in range(n)],
        "l_returnflag": [rng.choice("ANR") for _ in range(n)],
        "l_linestatus": [rng.choice("FO") for _ in range(n)],
        "l_shipdate": [some_day(rng, dt.datetime(2000, 2, 29)) for _ in range(n)],
    }
    return pa.table(rows, schema=oracle_schema("lineitem"))


FRAGMENTS = [
    "select", "SELECT", "with", "WITH", "drop", "Update", "call", "recall", "ſelect", "_", "x", "é", "ก", "7", " ", "  ", "\t", "\n",
    "\r", "\x0b", "\x1f", "\x85", " ", " ", "　", ";", ";;", "'", "(", ")", ",", "-", "—", "```", "```sql", "```SQL ", "`",
]


def odd_text(rng):
    return "".join(rng.choice(FRAGMENTS) for _ in range(rng.randrange(0, 9)))


def documents(rng, n):
    rows = {
        "doc_id": list(range(n)),
        "text": [odd_text(rng) for _ in range(n)],
        "lang": ["en"] * n,
        "source": ["s"] * n,
        "n_chars": [0] * n,
    }
    return pa.table(rows, schema=oracle_schema("documents"))


def oracle_schema(name):
    return pq.read_schema(f"/root/testdata/sf0.001/{name}.parquet").remove_metadata()


@pytest.fixture(scope="module")
def hard(tmp_path_factory):
    rng = random.Random(20)
    folder = str(tmp_path_factory.mktemp("hard"))
    made = {"orders": orders(rng, 4000), "lineitem": lineitem(rng, 6000), "documents": documents(rng, 6000)}
    for name in oracle.TABLES:
        table = made.get(name)
        if table is None:
            table = pq.read_table(f"/root/testdata/sf0.001/{name}.parquet")
        pq.write_table(table, f"{folder}/{name}.parquet")
    return folder, oracle.connect(folder)


# Queries on events, customers and suppliers see the ordinary tables; test_oracle covers them.
ORDINARY = {"latest_batch", "scalar_payload", "normalize_event_snapshot", "upsert_dim", "scan_parquet"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ORDINARY))
def test_same_rows_as_sql(spark, hard, name):
    folder, con = hard
    problems, _ = oracle.differences(
        spark, con, QUERIES[name], ORACLE_SQL[name], folder
    )
    assert problems == []
