"""Where queries and their SQL are gathered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *ctes: str) -> Callable[[Query], Query]:
    """Registers a query; ctes are the views its SQL begins with."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = f"WITH {','.join(ctes)}\n{sql}" if ctes else sql
        return fn

    return register
