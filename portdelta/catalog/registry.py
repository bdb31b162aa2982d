"""Where queries and their SQL twins are entered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Enter a query, with the SQL that must give the same rows."""

    def enter(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} entered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return enter
