"""Query registry: name -> Spark query and name -> DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
