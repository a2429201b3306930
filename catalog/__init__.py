"""Registered queries: each operator on the shared test tables, with the SQL it must agree with.

A query and its SQL stand side by side. Both round floating columns the same
way, because sums in different order differ in the last bits: ``shown`` and
``q`` add 1e-9 before rounding, so a value exactly between two decimals does not
depend on those bits.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # predictors defined here run in tasks

NUDGE = 1e-9
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def shown(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating columns rounded for comparison."""
    return df.select(*[
        F.round(F.col(f.name).cast("double") + NUDGE, digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema
    ])


def q(expr: str, name: str | None = None, digits: int = 4) -> str:
    return f"round(({expr})::DOUBLE + 1e-9, {digits}) AS {name or expr}"


def qs(names, digits: int = 4) -> str:
    return ", ".join(q(n, n, digits) for n in names)


def register(name: str, sql: str | None = None, digits: int = 4):
    """Decorator: the function is the query, ``sql`` its DuckDB equivalent."""

    def wrap(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return shown(fn(spark, folder), digits)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load_all() -> None:
    from . import features, forecasts, models, samples, sinks, statistics, windows  # noqa: F401
