"""Registry of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: puts a ``(spark, sf_dir) -> DataFrame`` function in the registry, with its DuckDB equivalent."""

    def put(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return put


from methylspark.plans import queries as _queries  # noqa: E402, F401  registers the queries
