"""Unit-root test: the number of lags and the statistic from one pass of cross products.

Rows are packed once into blocks of consecutive values (the only shuffle of the rows). A block adds the cross products of
(1, level, lagged steps, step) over the rows that have all lags of their series. One triangular factor of their sum gives the
sum of squares of every number of lags. The chosen number's own sample has a few rows more, at the beginning of the series;
they are taken into the factor from the first values, which the first block hands on, so the rows aren't read again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..schema import TARGET
from ..session import materialize
from .autoreg import _solve
from .css import ALL, BLOCK_ROWS, _joined, _lists, _named
from .slices import first_rows
from .timeline import CHUNK, HOME, Layout, Timeline, plan_layout

# Rows of a block that are laid out with all their lags at a time.
STRIP_ROWS = 8_192
# A column whose part outside the columns before it is smaller than this (squared, of unit length) depends on them.
DEPENDENT = 1e-9

# MacKinnon's (1994) response surface for the constant-only test, one variable.
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.83, -1.61
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def mackinnon_p(stat: float) -> float:
    if stat > ADF_TAU_MAX:
        return 1.0
    if stat < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALL_P if stat <= ADF_TAU_STAR else ADF_LARGE_P
    z = sum(c * stat ** i for i, c in enumerate(coef))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def _aic(m: np.ndarray, lags: int, size: float) -> float:
    at = [*range(2 + lags), len(m) - 1]
    ssr = max(_solve(m[np.ix_(at, at)])[1], 1e-300)
    return size * (math.log(2 * math.pi * ssr / size) + 1) + 2 * (2 + lags)


def _statistic(m: np.ndarray, lags: int) -> tuple[float, int]:
    """Statistic of the level's weight, and sample size."""
    at = [*range(2 + lags), len(m) - 1]
    own = m[np.ix_(at, at)]
    k = 2 + lags
    beta, ssr = _solve(own)
    if own[0, 0] <= k:
        return float("nan"), int(own[0, 0])
    variance = ssr / (own[0, 0] - k) * np.linalg.pinv(own[:k, :k])[1, 1]
    return (float(beta[1] / math.sqrt(variance)) if variance > 0 else float("nan")), int(own[0, 0])


def _strip(y: np.ndarray, mean: float, lags: int, a: int, b: int) -> np.ndarray:
    """Rows a to b (1, level, lagged steps, step) of a run of values; row a looks back on ``lags + 1`` values."""
    step = np.diff(y[a - 1 - lags:b])
    rows = b - a
    columns = [np.ones(rows), y[a - 1:b - 1] - mean, *(step[lags - k:lags - k + rows] for k in range(1, lags + 1)), step[lags:]]
    return np.column_stack(columns)


def cross_products(y: np.ndarray, mean: float, lags: int, first: int) -> np.ndarray:
    """Sum over the rows from ``first`` on, in strips."""
    total = np.zeros((lags + 3, lags + 3))
    for a in range(first, len(y), STRIP_ROWS):
        x = _strip(y, mean, lags, a, min(len(y), a + STRIP_ROWS))
        total += x.T @ x
    return total


def early_rows(head: np.ndarray, mean: float, lags: int) -> np.ndarray:
    """Rows of a sample with ``lags`` lags that the common sample leaves out; ``head`` are the first values."""
    rows = [_strip(head, mean, lags, t, t + 1) for t in range(lags + 1, len(head))]
    return np.concatenate(rows) if rows else np.zeros((0, lags + 3))


def _factor(m: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Upper factor of the cross products, columns scaled to unit length, and the lengths; None if columns are dependent."""
    size = np.sqrt(np.diag(m))
    if not (size > 0).all():
        return None
    try:
        r = np.linalg.cholesky(m / np.outer(size, size)).T
    except np.linalg.LinAlgError:
        return None
    return (r, size) if (np.diag(r)[:-1] ** 2 > DEPENDENT).all() else None


def unit_root(m: np.ndarray, head: np.ndarray, mean: float) -> tuple[float, int, int]:
    """Statistic, lags of least AIC and sample size, from the common sample and the first ``lags + 1`` values."""
    most = len(m) - 3
    found = _factor(m)
    if found is None:
        return _dependent(m, head, mean)
    r, size = found
    n, c = m[0, 0], r[:, -1] * size[-1]
    left = np.cumsum(c[::-1] ** 2)[::-1]                # left[j]: sum of squares that the first j columns leave
    aic = [n * (math.log(2 * math.pi * max(left[2 + k], 1e-300) / n) + 1) + 2 * (2 + k) for k in range(most + 1)]
    lags = int(np.argmin(aic))
    k = 2 + lags
    top = np.zeros((k + 1, k + 1))
    top[:k, :k], top[:k, k], top[k, k] = r[:k, :k], r[:k, -1], math.sqrt(left[k]) / size[-1]
    at = [*range(k), most + 2]
    early = early_rows(head, mean, lags)
    whole = np.linalg.qr(np.concatenate([top, early / size[at]]), mode="r")
    nobs = int(round(n)) + len(early)
    if nobs <= k:
        return float("nan"), lags, nobs
    inverse = np.linalg.inv(whole[:k, :k])
    beta, variance = inverse @ whole[:k, k], whole[k, k] ** 2 / (nobs - k) * (inverse[1] ** 2).sum()
    return (float(beta[1] / math.sqrt(variance)) if variance > 0 else float("nan")), lags, nobs


def _dependent(m: np.ndarray, head: np.ndarray, mean: float) -> tuple[float, int, int]:
    """The same where columns depend on each other: they share their effect, and lags without any step aren't used."""
    used = [k for k in range(len(m) - 2) if k == 0 or m[1 + k, 1 + k] > 0]
    lags = min(used, key=lambda k: _aic(m, k, m[0, 0])) if m[0, 0] else 0
    at = [*range(2 + lags), len(m) - 1]
    early = early_rows(head, mean, lags)
    stat, nobs = _statistic(m[np.ix_(at, at)] + early.T @ early, lags)
    return stat, lags, nobs


def _packed(data: DataFrame, keys, order, layout: Layout, halo: int) -> DataFrame:
    """Rows (keys, part, n, first, total, v): a block's n values after up to ``halo`` before it, in row order."""
    t = Timeline(data, layout, halo)
    own = F.col(HOME) if layout.chunked else F.lit(True)
    part = F.col(CHUNK) if layout.chunked else F.lit(0).cast("long")
    rows = t.df.withColumns({"__pos": t.position(), "__sum": t.total()}).select(*keys, part.alias("part"), own.alias("__own"), "__pos", "__sum", "y")
    return materialize(rows.groupBy(*keys, "part").agg(
        F.count_if("__own").alias("n"), F.min(F.when(F.col("__own"), F.col("__pos"))).alias("first"), F.max("__sum").alias("total"),
        F.sort_array(F.collect_list(F.struct("__pos", "y"))).alias("v"),
    ))


def _values(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    lists = batch.column("v")
    edges, y = lists.offsets.to_numpy(), lists.values.field(1)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield y.slice(a, b - a).to_numpy(zero_copy_only=False)


def adf_test(df: DataFrame, column: str = TARGET, max_rows: int | None = None, series=(), order=("date",),
             layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Unit-root test with a constant, per series; the lag count minimises AIC. ``d`` is the differencing it asks for.

    Lag counts are compared on the sample that all of them have; the statistic is that of the chosen count's own, longer
    sample. With ``max_rows`` the first so many rows of each series count. Missing values are left out; series of fewer
    than 8 values get no statistic and d = 1, and an empty table gives no rows.
    """
    keys, order = list(series) or [ALL], list(order)
    data = df.select(*dict.fromkeys([*series, *order]), F.col(column).cast("double").alias("y"))
    if max_rows is not None:
        data = first_rows(data, max_rows, series=series, order=order)
    data = data.filter(F.col("y").isNotNull() & ~F.isnan("y"))
    data = data if series else data.withColumn(ALL, F.lit(0))
    n = F.count(F.lit(1))
    deepest = F.greatest(F.lit(0), F.least(F.ceil(F.pow(n / 100.0, 0.25) * 12), F.floor(n / 2) - 2)).cast("int")
    sizes = materialize(data.groupBy(*keys).agg(n.alias("n"), deepest.alias("lags"), F.avg("y").alias("mean")))
    count, most = sizes.agg(F.count(F.lit(1)), F.max("lags")).first()
    layout = layout or plan_layout(data.select(*keys, *order), keys, order, chunk_rows or BLOCK_ROWS)
    blocks = _joined(_packed(data, keys, order, layout, (most or 0) + 1), sizes.filter("n >= 8").select(*keys, "lags", "mean"), keys, count)
    named = _named(data, keys)

    def tested(batch: pa.RecordBatch, found) -> pa.RecordBatch:
        stats, lags, nobs = zip(*found) if found else ((), (), ())
        columns = [pa.array(stats, pa.float64()), pa.array([mackinnon_p(s) for s in stats], pa.float64()), pa.array(lags, pa.int32()), pa.array(nobs, pa.int64())]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *columns], names=[*keys, "statistic", "p_value", "used_lag", "nobs"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(_values(batch), batch.column("lags").to_pylist(), batch.column("mean").to_pylist())
            yield tested(batch, [unit_root(cross_products(y, mean, lags, lags + 1), y[:lags + 1], mean) for y, lags, mean in given])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, heads = [], []
            for y, lags, mean, own, first in zip(_values(batch), *(batch.column(c).to_pylist() for c in ("lags", "mean", "n", "first"))):
                found.append(cross_products(y, mean, lags, max(len(y) - own, lags + 1 - first + len(y) - own)).ravel() if own else None)
                heads.append(y[:lags + 1] if first == 0 else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), _lists(found), _lists(heads)], names=[*keys, "sums", "head"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(batch.column("sums").to_pylist(), batch.column("head").to_pylist(), batch.column("mean").to_pylist())
            yield tested(batch, [unit_root(np.reshape(s, (math.isqrt(len(s)), -1)), np.array(h), mean) for s, h, mean in given])

    result = f"{named}, statistic double, p_value double, used_lag int, nobs bigint"
    found = blocks.filter("n = total").mapInArrow(alone, result)
    if layout.chunked:
        parts = materialize(blocks.filter("n < total").mapInArrow(sums, f"{named}, sums array<double>, head array<double>"))
        entries = parts.select(*keys, F.posexplode("sums").alias("i", "g")).groupBy(*keys, "i").agg(F.sum("g").alias("g"))
        summed = entries.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "g"))).alias("s")).select(*keys, F.col("s.g").alias("sums"))
        heads = _joined(parts.filter(F.col("head").isNotNull()).select(*keys, "head"), sizes.select(*keys, "mean"), keys, count)
        found = found.unionByName(_joined(summed, heads, keys, count).mapInArrow(decide, result))
    out = _joined_left(sizes.select(*keys), found, keys).select(
        *keys, *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("statistic", "p_value")), F.coalesce("used_lag", F.lit(0)).alias("used_lag"),
        F.coalesce("nobs", F.lit(0).cast("bigint")).alias("nobs"), F.when(F.col("p_value") < 0.05, 0).otherwise(1).alias("d"),
    )
    return out.drop(ALL)


def _joined_left(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    on = [F.col(c).alias(f"__k_{c}") for c in keys]
    right = right.select(*on, *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return left.join(right, cond, "left").drop(*[f"__k_{c}" for c in keys])
