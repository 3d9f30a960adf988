"""Table of queries: name -> function of (session, table folder), and name -> SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql`` is run on the same tables by another engine to check it."""

    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add
