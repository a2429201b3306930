"""Walk-forward validation of models that are fitted by iteration, every fold from scratch.

All folds advance together: one pass over the rows per iteration sums what each unfinished fold's model asks for over the
fold's own training rows. Training parts are nested, so a row carries the number of the first fold that trains on it and is
read once for all folds. A model is any picklable object with ``start``, ``sums``, ``step`` and ``predict``; sums must add
up over rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import naive
from ..schema import DATE, FEATURES, SEQUENCE_LENGTH, TARGET, TARGET_SCALED, present
from ..session import materialize
from .folds import usable_bounds
from .linear import fold_spans, fold_table, _shifts
from .scaling import ScalerStats

ROUNDS = 100


def _solved(a: np.ndarray, b: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of normal equations whose first column is the constant, which isn't penalised."""
    a = a + penalty * np.diag([0.0] + [1.0] * (len(a) - 1))
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    return np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-11)[0] / scale


@dataclass(frozen=True)
class Huber:
    """Regression that counts errors beyond ``delta`` linearly, by reweighted least squares."""

    delta: float = 1.345
    penalty: float = 0.0
    tolerance: float = 1e-9

    def start(self, columns: int) -> np.ndarray:
        return np.zeros(columns)

    def sums(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        error = y - x @ params
        w = np.minimum(1.0, self.delta / np.maximum(np.abs(error), 1e-300))
        xw = x * w[:, None]
        return np.concatenate(((xw.T @ x).ravel(), xw.T @ y))

    def step(self, params: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, bool]:
        k = len(params)
        new = _solved(sums[:k * k].reshape(k, k), sums[k * k:], self.penalty)
        return new, bool(np.abs(new - params).max() <= self.tolerance * max(1.0, np.abs(new).max()))

    def predict(self, params: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ params


@dataclass(frozen=True)
class SignLogit:
    """Probability that the target is above 0, by Newton's method; the prediction is that probability less a half."""

    penalty: float = 1.0
    tolerance: float = 1e-9

    def start(self, columns: int) -> np.ndarray:
        return np.zeros(columns)

    def sums(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = 0.5 * (1 + np.tanh(0.5 * (x @ params)))
        xw = x * (p * (1 - p))[:, None]
        return np.concatenate(((xw.T @ x).ravel(), x.T @ ((y > 0) - p)))

    def step(self, params: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, bool]:
        k = len(params)
        slope = sums[k * k:] - self.penalty * np.concatenate(([0.0], params[1:]))
        move = _solved(sums[:k * k].reshape(k, k), slope, self.penalty)
        return params + move, bool(np.abs(move).max() <= self.tolerance * max(1.0, np.abs(params).max()))

    def predict(self, params: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 0.5 * np.tanh(0.5 * (x @ params))


def refit_per_fold(df: DataFrame, bounds: list[tuple], features=FEATURES, target: str = TARGET_SCALED, model=None,
                   stats: ScalerStats | None = None, raw_target: str = TARGET, length: int = SEQUENCE_LENGTH, ts: str = DATE,
                   order=None, rounds: int = ROUNDS) -> DataFrame:
    """The table of ``walk_forward_cv`` for a model fitted by iteration, and how many iterations each fold took.

    Rows with a missing feature or target neither train nor count in a loss. Columns reach the model less their means over
    all rows, after a column of ones. Folds that don't settle within ``rounds`` iterations keep their last parameters.
    """
    order, model = tuple(order or (ts,)), model or Huber()
    cols = present(df, features)
    usable = usable_bounds(df, bounds, length, ts)
    spark = df.sparkSession
    folds = [i for i, b in enumerate(bounds, start=1) if b in usable]
    block = F.lit(0)
    for _, start, _ in bounds:
        block = block + (F.col(ts) >= naive(start)).cast("int")
    keep = [c for c in dict.fromkeys([*order, ts])]
    blocked = df.filter(F.col(ts) <= naive(bounds[-1][2])).select(block.alias("block"), *keep, F.col(target).cast("double").alias("__y"), *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    blocked = materialize(blocked)  # read once per iteration
    names = [f"__x{i}" for i in range(len(cols))]
    shifts = np.array(_shifts(blocked, names)) if cols else np.zeros(0)

    def design(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, y = pdf[names].to_numpy(dtype=float) - shifts, pdf["__y"].to_numpy(dtype=float)
        whole = np.isfinite(x).all(axis=1) & np.isfinite(y)
        return np.column_stack((np.ones(whole.sum()), x[whole])), y[whole], pdf["block"].to_numpy()[whole]

    def summed(params: dict, of) -> dict:
        """Sums over each fold's training rows; a few numbers per fold come back."""

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: dict = {}
            for pdf in batches:
                x, y, number = design(pdf)
                for fold, p in params.items():
                    own = number < fold
                    if own.any():
                        part = of(p, x[own], y[own])
                        held[fold] = held[fold] + part if fold in held else part
            for fold, part in held.items():
                yield pd.DataFrame({"fold": fold, "i": range(len(part)), "g": part})

        rows = blocked.select("block", "__y", *names).mapInPandas(partial, "fold int, i int, g double").groupBy("fold", "i").agg(F.sum("g").alias("g")).collect()
        out: dict = {}
        for r in sorted(rows, key=lambda r: (r["fold"], r["i"])):
            out.setdefault(r["fold"], []).append(r["g"])
        return {fold: np.array(v) for fold, v in out.items()}

    params = {fold: model.start(len(cols) + 1) for fold in folds}
    taken, open_ = {fold: 0 for fold in folds}, set(folds)
    while open_ and max(taken.values()) < rounds:
        sums = summed({f: params[f] for f in open_}, model.sums)
        for fold in sorted(open_):
            if fold not in sums:  # no complete row to train on
                open_.discard(fold)
                continue
            params[fold], done = model.step(params[fold], sums[fold])
            taken[fold] += 1
            if done:
                open_.discard(fold)

    def square(p, x, y):
        return np.array([((y - model.predict(p, x)) ** 2).sum(), float(len(y))])

    losses = {fold: float(s[0] / s[1]) for fold, s in summed(params, square).items()} if folds else {}

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.full(len(pdf), np.nan)
            x = np.column_stack((np.ones(len(pdf)), pdf[names].to_numpy(dtype=float) - shifts))
            for fold, p in params.items():
                own = (pdf["block"] == fold).to_numpy()
                if own.any():
                    out[own] = model.predict(p, x[own])
            yield pdf[["block", *keep]].assign(actual=pdf["__y"], predicted=out)

    kinds = {f.name: f.dataType.simpleString() for f in blocked.schema}
    scored = blocked.filter(F.col("block").isin(folds)).mapInPandas(predicted, ", ".join(f"`{c}` {kinds[c]}" for c in ("block", *keep)) + ", actual double, predicted double")
    scored = scored.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("actual", "predicted")})
    table = fold_table(spark, scored, fold_spans(blocked, ts), folds, losses, stats, raw_target, length, order)
    numbers = {number: taken[i] for number, i in enumerate(folds, start=1)}
    rounds_of = F.create_map(*[F.lit(v) for pair in numbers.items() for v in pair])[F.col("fold_id")] if numbers else F.lit(None).cast("int")
    return table.withColumn("iterations", rounds_of)
