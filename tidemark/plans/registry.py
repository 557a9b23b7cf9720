"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the tables of ``sf_dir`` (or
data Spark derives from them).  The oracle is the same result written as plain
SQL over the pre-registered views; it is optional only for operators that SQL
cannot express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def query(name: str, operators: tuple[str, ...] = (), oracle: str | None = None):
    """Register ``fn`` under ``name``; ``operators`` lists the SURVEY ids it covers."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = tuple(operators)
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco
