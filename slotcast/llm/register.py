"""Queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: the function is the query, ``sql`` its DuckDB equivalent."""

    def wrap(fn):
        QUERIES[name] = lambda spark, folder: fn(prepared(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
