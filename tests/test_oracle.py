"""Every registered query against its SQL, on the smallest test tables."""

import __spark_entry__ as spark_entry
import oracle
import pytest

from macrolake.plans.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    problems, _ = oracle.differences(
        spark, con, spark_entry.queries()[name], spark_entry.oracle_sql()[name], SF_DIR
    )
    assert problems == []


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
