"""Collects the check queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE_SQL[name] = sql
        return query

    return register
