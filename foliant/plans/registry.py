"""Where registered queries and their SQL meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query (spark, table folder) -> DataFrame with the SQL that
    gives the same rows, where there is one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register
