"""Query catalogue: each module registers Spark queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its inventory id, with its SQL twin if it has one."""

    def register(fn: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
