"""Ridge regression on the feature vector: walk-forward validation and windowed scoring."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import naive
from ..schema import DATE, FEATURES, SEQUENCE_LENGTH, TARGET, TARGET_SCALED, present
from ..session import materialize
from .evaluate import error_metrics
from .folds import usable_bounds
from .gram import gram, to_matrix
from .scaling import ScalerStats
from .timeline import HOME, Layout, Timeline, plan_layout
from .windows import indexed

# Windows of one task's group are built from at most about this many rows.
SCORE_CHUNK_ROWS = 65_536
SCORE_BATCH = 1024


@dataclass(frozen=True)
class LinearModel:
    """Weights on the last row of a window; callable on an array of windows (m, length, features)."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        return windows[:, -1, :].astype(float) @ np.array(self.weights) + self.intercept

    def expression(self):
        """The same prediction as a column of the current row."""
        out = F.lit(self.intercept)
        for c, w in zip(self.features, self.weights):
            out = out + F.col(c) * w
        return out


def ridge(m: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Constant and weights, and the mean squared error, from the cross products of (1, features..., target).

    The constant is not penalised. Columns should have been shifted to near zero mean before they were summed.
    """
    n = m[0, 0]
    mean = m[0, 1:] / n
    c = m[1:, 1:] - n * np.outer(mean, mean)
    k = len(c) - 1
    w = np.linalg.solve(c[:k, :k] + penalty * np.eye(k), c[:k, k])
    v = np.append(w, -1.0)
    return np.concatenate([[mean[k] - mean[:k] @ w], w]), float(max(v @ c @ v, 0.0) / n)


def _shifts(df: DataFrame, columns) -> list[float]:
    """Means of the columns: products of unshifted columns far from zero lose what tells them apart."""
    row = df.agg(*[F.avg(F.col(c).cast("double")) for c in columns]).first()
    return [v if v is not None else 0.0 for v in row]


def _shifted(df: DataFrame, columns, shifts, keep=()) -> DataFrame:
    return df.select(*keep, F.lit(1.0).alias("one"), *[(F.col(c).cast("double") - F.lit(v)).alias(f"c{i}") for i, (c, v) in enumerate(zip(columns, shifts))])


def _unshifted(beta: np.ndarray, shifts) -> np.ndarray:
    """The constant for columns as they were."""
    return np.concatenate([[beta[0] + shifts[-1] - float(np.dot(beta[1:], shifts[:-1]))], beta[1:]])


def _collect_gram(df: DataFrame, columns, group: str | None, k: int) -> dict:
    """At most groups * k^2 / 2 numbers."""
    rows = gram(df, columns, [group] if group else []).collect()
    parts: dict = {}
    for r in rows:
        parts.setdefault(r[group] if group else None, []).append((r["i"], r["j"], r["g"]))
    return {g: to_matrix(p, k) for g, p in parts.items()}


def fit_ridge(df: DataFrame, features=FEATURES, target: str = TARGET_SCALED, penalty: float = 1.0) -> LinearModel:
    cols = present(df, features)
    shifts = _shifts(df, [*cols, target])
    names = ["one", *(f"c{i}" for i in range(len(cols) + 1))]
    m = _collect_gram(_shifted(df, [*cols, target], shifts), names, None, len(names))
    if None not in m or m[None][0, 0] == 0:
        raise ValueError("no complete rows to fit on")
    beta = _unshifted(ridge(m[None], penalty)[0], shifts)
    return LinearModel(tuple(cols), tuple(float(b) for b in beta[1:]), float(beta[0]))


def walk_forward_cv(df: DataFrame, bounds: list[tuple], features=FEATURES, target: str = TARGET_SCALED,
                    stats: ScalerStats | None = None, raw_target: str = TARGET, penalty: float = 1.0,
                    length: int = SEQUENCE_LENGTH, ts: str = DATE, order=None) -> DataFrame:
    """Fit and score every fold: one pass for all fits, one for all scores.

    The folds' training parts are nested, so rows are summed once per block of
    time between two bounds and a fold's sums are the running total of the
    blocks before it. Blocks are cut by all bounds, whether their folds are
    usable or not; usable folds are numbered in time order. A fold is scored from
    its ``length``-th validation row on, in the target's own unit when ``stats``
    is given.
    """
    order = tuple(order or (ts,))
    cols = present(df, features)
    usable = usable_bounds(df, bounds, length, ts)
    spark = df.sparkSession
    if not usable:
        return spark.createDataFrame([], FOLD_SCHEMA)
    blocks = [i for i, b in enumerate(bounds, start=1) if b in usable]
    block = F.lit(0)
    for _, start, _ in bounds:
        block = block + (F.col(ts) >= naive(start)).cast("int")
    inside = F.col(ts) <= naive(bounds[-1][2])
    blocked = df.withColumn("block", block).filter(inside)
    shifts = _shifts(df, [*cols, target])
    spans = fold_spans(blocked, ts)
    k = len(cols) + 2
    names = ["one", *(f"c{i}" for i in range(len(cols) + 1))]
    grams = _collect_gram(_shifted(blocked, [*cols, target], shifts, ["block"]), names, "block", k)
    fits, train = {}, np.zeros((k, k))
    for i in range(1, len(bounds) + 1):
        train = train + grams.get(i - 1, np.zeros((k, k)))
        if i in blocks:
            beta, loss = ridge(train, penalty)
            fits[i] = (_unshifted(beta, shifts), loss)

    # the weights of a row's fold, picked from a small literal table by block number
    def weight(j):
        return F.element_at(F.array(*[F.lit(float(fits[i][0][j]) if i in fits else 0.0) for i in range(1, len(bounds) + 1)]), F.col("block"))

    predicted = weight(0)
    for j, c in enumerate(cols, start=1):
        predicted = predicted + F.col(c) * weight(j)
    scored = blocked.filter(F.col("block").isin(blocks)).select("block", *order, F.col(target).alias("actual"), predicted.alias("predicted"))
    return fold_table(spark, scored, spans, blocks, {i: fits[i][1] for i in blocks}, stats, raw_target, length, order)


FOLD_SCHEMA = (
    "fold_id int, train_start string, train_end string, val_start string, val_end string, train_rows bigint, "
    "val_rows bigint, scored_rows bigint, train_loss double, val_loss double, val_mae double, val_rmse double, "
    "val_r2 double, overfit_gap double"
)


def fold_spans(blocked: DataFrame, ts: str) -> dict:
    """Rows, first and last time of each block of time between two bounds."""
    spans = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return {r["block"]: r for r in spans.collect()}


def fold_table(spark, scored: DataFrame, spans: dict, blocks, losses: dict, stats: ScalerStats | None, raw_target: str, length: int, order) -> DataFrame:
    """One row per fold from its scored validation rows (block, order..., actual, predicted) and training losses."""
    if not blocks:
        return spark.createDataFrame([], FOLD_SCHEMA)
    scored = indexed(scored, ("block",), order).filter(F.col("row_index") >= length - 1)
    mean, scale = stats[raw_target] if stats is not None else (0.0, 1.0)
    scored = scored.withColumns({c: F.col(c) * scale + mean for c in ("actual", "predicted")})
    metrics = {r["block"]: r for r in error_metrics(scored, by=("block",)).collect()}

    def day(value):
        return None if value is None else str(value)[:10]

    rows = []
    first = min(s["first"] for s in spans.values())
    for number, i in enumerate(blocks, start=1):
        m = metrics[i]
        val_loss = (m["rmse"] / scale) ** 2
        before = [spans[b] for b in spans if b < i]
        rows.append((
            number, day(first), day(max(s["last"] for s in before)), day(spans[i]["first"]), day(spans[i]["last"]),
            sum(s["n"] for s in before), spans[i]["n"], m["n"], losses.get(i), val_loss, m["mae"], m["rmse"], m["r2"],
            None if losses.get(i) is None else val_loss - losses[i],
        ))
    return spark.createDataFrame(rows, FOLD_SCHEMA)


def score_windows(df: DataFrame, features, predictor: Callable[[np.ndarray], np.ndarray],
                  length: int = SEQUENCE_LENGTH, series=(), order=("date",), keep=(), name: str = "predicted",
                  layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """A prediction per row from its last ``length`` rows; NULL for the first ``length - 1`` rows of a series.

    Sliding windows are views on each group's feature array, so a row's features
    are shuffled once and not ``length`` times. Groups are series or chunks of
    them, never larger than a chunk and its halo.
    """
    features, keep = list(features), [c for c in keep if c not in (*series, *order)]
    layout = layout or plan_layout(df, series, order, chunk_rows or SCORE_CHUNK_ROWS)
    t = Timeline(df.select(*series, *order, *keep, *features), layout, halo=length - 1)
    home = F.col(HOME) if layout.chunked else F.lit(True)
    data = t.df.select(
        *([F.col(c) for c in t.by] or [F.lit(0).alias("__all")]),
        *[F.col(c) for c in (*order, *keep) if c not in t.by], home.alias("__is_home"),
        *[F.col(c).cast("float").alias(f"__f{i}") for i, c in enumerate(features)],
    )
    group = t.by or ["__all"]
    out_columns = [*series, *order, *keep]
    kinds = {f.name: f.dataType.simpleString() for f in data.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in out_columns] + [f"`{name}` double"])
    width = len(features)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        x = pdf[[f"__f{i}" for i in range(width)]].to_numpy(dtype=np.float32)
        result = np.full(len(pdf), np.nan)
        if len(x) >= length:
            views = np.lib.stride_tricks.sliding_window_view(x, length, axis=0).transpose(0, 2, 1)
            for at in range(0, len(views), SCORE_BATCH):
                part = np.asarray(predictor(views[at:at + SCORE_BATCH]), dtype=float)
                result[length - 1 + at:length - 1 + at + len(part)] = part
        out = pdf[out_columns].assign(**{name: result})
        return out[pdf["__is_home"].to_numpy(dtype=bool)]

    scored = data.groupBy(*group).applyInPandas(score, schema)
    return scored.withColumn(name, F.when(~F.isnan(name), F.col(name)))


def align_predictions(rows: DataFrame, predictions: DataFrame, keys=(DATE,), name: str = "predicted",
                      order=(DATE,), series=()) -> DataFrame:
    """Predictions placed at their rows; rows before a series' first prediction take that first one.

    Holes further on stay NULL. ``order`` and ``series`` are columns of both tables, ``series`` part of ``keys``.
    """
    order, series = list(order), list(series)
    valid = materialize(predictions.filter(F.col(name).isNotNull()).select(*dict.fromkeys([*series, *keys, *order]), name))
    at = F.struct(*order)
    first = valid.groupBy(*series).agg(F.min(at).alias("__at"), F.min_by(name, at).alias("__first"))
    joined = rows.join(valid.select(*dict.fromkeys([*series, *keys]), name), list(dict.fromkeys([*series, *keys])), "left")
    # without series the right side is one row
    joined = joined.join(first, series, "left") if series else joined.join(F.broadcast(first), F.lit(True), "left")
    early = at < F.col("__at")
    return joined.withColumn(name, F.when(early, F.coalesce(F.col(name), F.col("__first"))).otherwise(F.col(name))).drop("__at", "__first")
