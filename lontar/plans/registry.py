"""Where the catalogue's modules put their queries and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function as a query, with the DuckDB SQL for its rows if there is any."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return put
