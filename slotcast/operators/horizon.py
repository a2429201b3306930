"""Forecasts many steps ahead, in blocks of steps that don't wait for each other.

A forecast is a linear recurrence from a series' last values, with shocks that fade out after the moving average's order.
Powers of its one-step matrix lead straight to the values before any block of steps; inside a block the recurrence runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .recurrence import companion, newest, run
from .timeline import Timeline, plan_layout

STEPS = 16_384
STEP, VALUE = "__step", "__value"


def block_values(psi: np.ndarray, const: float, moving: np.ndarray, last: np.ndarray, shocks: np.ndarray, first: int, count: int) -> np.ndarray:
    """Values of ``count`` steps after the first ``first`` ones; ``last`` and ``shocks`` are newest first."""
    d, k = len(psi), len(moving)
    if len(last) < d or not np.isfinite(last[:d]).all():
        return np.full(count, np.nan)
    early = np.full(max(k, 1), float(const))
    for h in range(1, k + 1):
        known = min(k - h + 1, len(shocks))
        early[h - 1] += moving[h - 1:h - 1 + known] @ shocks[:known]
    state = last[:d, None]
    if first == 0:
        x = np.full(count, float(const))
        x[:len(early)] = early[:count]
        return run(x[:, None], psi, state)[:, 0]
    if first < len(early):
        raise ValueError("a block of steps must not be shorter than the moving average")
    state = newest(state, run(early[:, None], psi, state))
    jump = np.zeros((d + 1, d + 1))
    jump[:d, :d], jump[d, d] = companion(psi), 1.0
    if d:
        jump[0, d] = const
    state = (np.linalg.matrix_power(jump, first - len(early)) @ np.append(state[:, 0], 1.0))[:d, None]
    return run(np.full((count, 1), float(const)), psi, state)[:, 0]


def forecast_steps(states: DataFrame, future: DataFrame, series, order, weigh: Callable, name: str, steps: int = STEPS, layout=None) -> DataFrame:
    """Every row of ``future`` with its forecast: row h of a series is h steps after the series' last value.

    ``states`` has one row per series: series..., beta, last, shocks (newest first). ``weigh(beta)`` gives the weights of
    the last values, the constant and the weights of the shocks. Only (series, step) numbers reach Python tasks, in blocks
    of ``steps``; the rows themselves are joined to the results. Series without a state get NULL.
    """
    series, order = list(series), list(order)
    keys = [f"__k_{c}" for c in series] or ["__k"]
    named = [F.col(c).alias(k) for c, k in zip(series, keys)] or [F.lit(0).alias("__k")]
    t = Timeline(future, layout or plan_layout(future.select(*series, *order), series, order))
    number = "steps_ahead"
    rows = t.close(t.df.withColumn(number, t.position() + 1))
    lengths = rows.select(*named, number).groupBy(*keys).agg(F.max(number).alias("most"))
    state = states.select(*[c.alias(f"__s{i}") for i, c in enumerate([F.col(c) for c in series] or [F.lit(0)])], "beta", "last", "shocks")
    same = None
    for i, k in enumerate(keys):
        eq = F.col(k).eqNullSafe(F.col(f"__s{i}"))
        same = eq if same is None else same & eq
    blocks = lengths.join(state, same).withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("most") - 1, F.lit(steps).cast("long"))))
    blocks = blocks.select(*keys, "first", F.least(F.lit(steps).cast("long"), F.col("most") - F.col("first")).alias("count"), "beta", "last", "shocks")
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = []
            for beta, last, shocks, first, count in zip(pdf["beta"], pdf["last"], pdf["shocks"], pdf["first"], pdf["count"]):
                psi, const, moving = weigh(np.asarray(beta, float))
                with np.errstate(all="ignore"):
                    values.append(block_values(psi, const, moving, np.asarray(last, float), np.asarray(shocks, float), int(first), int(count)))
            yield pdf[[*keys, "first"]].assign(values=values)

    # one block of steps a partition or few: blocks are dealt out before they are computed
    dealt = blocks.repartition(*[F.col(k) for k in keys], "first")
    found = dealt.mapInPandas(compute, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", first long, values array<double>")
    found = found.select(*keys, "first", F.posexplode("values").alias("__at", VALUE)).select(
        *[F.col(k).alias(f"__v{i}") for i, k in enumerate(keys)], (F.col("first") + F.col("__at") + 1).alias(STEP), VALUE
    )
    cond = F.col(number) == F.col(STEP)
    for i, c in enumerate([F.col(c) for c in series] or [F.lit(0)]):
        cond = cond & c.eqNullSafe(F.col(f"__v{i}"))
    joined = rows.join(found, cond, "left").drop(STEP, number, *[f"__v{i}" for i in range(len(keys))])
    return joined.withColumn(name, F.when(~F.isnan(VALUE), F.col(VALUE))).drop(VALUE)
