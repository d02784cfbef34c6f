"""Registry of named queries and their DuckDB twins.

``@query(name, sql=...)`` registers a callable ``(spark, sf_dir) -> DataFrame``;
``sql`` is the ANSI twin DuckDB runs on the same parquet tables (omitted for
operators that SQL cannot express, e.g. iterative model fitting).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco
