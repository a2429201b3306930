"""Autoregressive models by least squares, for one series or for many at once.

The reference solver is a state-space likelihood for a single series. Here the
same orders (p, d, q)(P, D, Q, m) and regressors are fitted by regression: lag
columns come from one window, their cross products are summed per series in one
pass, and only a small system per series is solved. Moving-average terms use the
two-stage regression of Hannan and Rissanen: residuals of a long autoregression
stand in for the unobserved shocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..schema import TARGET
from ..session import materialize
from .gram import gram_arrays
from .horizon import forecast_steps
from .timeline import HOME, Layout, Timeline, plan_layout, tasks_for

# Up to this many series the coefficients (a few dozen numbers each) are broadcast.
BROADCAST_SERIES = 50_000
# Series whose small systems a task solves.
TASK_SERIES = 4_096


@dataclass(frozen=True)
class ArxSpec:
    p: int = 2
    d: int = 0
    q: int = 0
    P: int = 0
    D: int = 0
    Q: int = 0
    m: int = 96
    exog: tuple[str, ...] = ()
    intercept: bool = True
    long_ar: int | None = None

    @staticmethod
    def _products(a: int, b: int, m: int) -> list[int]:
        return sorted({i + m * j for i in range(a + 1) for j in range(b + 1)} - {0})

    @property
    def ar_lags(self) -> list[int]:
        return self._products(self.p, self.P, self.m)

    @property
    def ma_lags(self) -> list[int]:
        return self._products(self.q, self.Q, self.m)

    @property
    def stage_one_lags(self) -> list[int]:
        """Lags of the long autoregression, seasonal neighbours included when the model is seasonal."""
        depth = self.long_ar or max(10, 2 * (self.p + self.q))
        lags = set(range(1, depth + 1)) | set(self.ar_lags)
        if self.P or self.Q:
            lags |= {self.m + i for i in range(0, max(self.p, self.q) + 1)}
        return sorted(lags)

    @property
    def difference_weights(self) -> dict[int, float]:
        """Lag -> weight of (1 - L)^d (1 - L^m)^D."""
        poly = {0: 1.0}
        for step in [1] * self.d + [self.m] * self.D:
            nxt = dict(poly)
            for lag, w in poly.items():
                nxt[lag + step] = nxt.get(lag + step, 0.0) - w
            poly = {k: v for k, v in nxt.items() if v}
        return poly

    @property
    def terms(self) -> list[str]:
        out = ["const"] if self.intercept else []
        out += [f"ar_{i}" for i in self.ar_lags] + [f"ma_{i}" for i in self.ma_lags]
        return out + [f"x_{c}" for c in self.exog]


@dataclass
class ArxModel:
    """Coefficient arrays per series: ``beta`` in ``spec.terms`` order, ``beta1`` of the long autoregression."""

    spec: ArxSpec
    series: tuple[str, ...]
    order: tuple[str, ...]
    target: str
    table: DataFrame            # series..., beta, beta1, nobs, sigma2
    count: int

    def coefficients(self) -> DataFrame:
        """Long form: series..., term, value."""
        names = F.array(*[F.lit(t) for t in self.spec.terms])
        return self.table.select(*self.series, F.explode(F.arrays_zip(names.alias("term"), F.col("beta").alias("value"))).alias("t")).select(
            *self.series, F.col("t.term").alias("term"), F.col("t.value").alias("value")
        )


def _solve(m: np.ndarray) -> tuple[np.ndarray, float]:
    """Least squares from cross products with the target last; dependent columns share their effect."""
    if len(m) == 1:
        return np.zeros(0), float(m[0, 0])
    a, b = m[:-1, :-1], m[:-1, -1]
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    beta = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-11)[0] / scale
    v = np.append(beta, -1.0)
    return beta, float(max(v @ m @ v, 0.0))


def _mean_of(column: str, spec: ArxSpec) -> str | None:
    """Name of the column that holds a design column's shift, if it has one."""
    if column == "__y" or column.startswith("__z"):
        return "__mean_y"
    return f"__mean_{spec.exog[int(column[3:])]}" if column.startswith("__x") else None


def _means(data: DataFrame, spec: ArxSpec, target: str, series) -> tuple[DataFrame, list[str]]:
    """Shifts per series: means of the target and of the regressors, unless they are differenced.

    Sums of products of columns far from zero can't tell a column from the constant. Without a constant there is
    nothing to take a shift up, so it is zero.
    """
    level = spec.intercept and len(spec.difference_weights) == 1
    shifts = [(F.avg(F.col(target).cast("double")) if level else F.lit(0.0)).alias("__mean_y")]
    shifts += [(F.avg(F.col(c).cast("double")) if level else F.lit(0.0)).alias(f"__mean_{c}") for c in spec.exog]
    names = ["__mean_y", *(f"__mean_{c}" for c in spec.exog)]
    table = data.groupBy(*series).agg(F.count(F.lit(1)).alias("__rows"), *shifts).select(*series, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in names])
    return table, names


def _fit_table(design: DataFrame, columns, series, name: str, spec: ArxSpec, means: DataFrame, count: int) -> DataFrame:
    """Solves one small system per series on shifted columns: ``series..., name, nobs, sigma2``."""
    k = len(columns) + 1
    keys = list(series) or ["__all"]
    data = design if series else design.withColumn("__all", F.lit(0))
    shift = {c: _mean_of(c, spec) for c in [*columns, "__y"]}
    data = data.withColumns({c: F.col(c) - F.col(m) for c, m in shift.items() if m})
    sums = gram_arrays(data.withColumn("__one", F.lit(1.0)), [*columns, "__y", "__one"], keys)
    kinds = {f.name: f.dataType.simpleString() for f in sums.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keys] + [f"{name} array<double>", "nobs bigint", "sigma2 double"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row is the upper triangle of one series' matrix
        upper = np.triu_indices(k + 1)
        for batch in batches:
            betas, nobs, sigma2 = [], [], []
            for g in batch.column("g").to_pylist():
                full = np.zeros((k + 1, k + 1))
                full[upper] = g
                full.T[upper] = g
                n = full[k, k]
                beta, ssr = _solve(full[:k, :k])
                betas.append(beta.tolist())
                nobs.append(int(round(n)))
                sigma2.append(ssr / n if n else None)
            made = [pa.array(betas, pa.list_(pa.float64())), pa.array(nobs, pa.int64()), pa.array(sigma2, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *made], names=[*keys, name, "nobs", "sigma2"])

    # dealt out by their number: the matrices are small, but each takes its time
    solved = sums.repartition(tasks_for(count, TASK_SERIES), *keys).mapInArrow(solve, schema)
    if not spec.intercept:
        return solved
    names = ["__mean_y", *(f"__mean_{c}" for c in spec.exog)]
    back = F.element_at(name, 1) + F.col("__mean_y")
    for i, c in enumerate(columns, start=1):
        if shift[c]:
            back = back - F.element_at(name, i) * F.col(shift[c])
    placed = _attach(solved, means, series, names, count)
    return placed.withColumn(name, F.concat(F.array(back), F.slice(name, 2, len(columns)))).drop(*names)


def _attach(df: DataFrame, table: DataFrame, series, columns, count: int) -> DataFrame:
    """Adds per-series values. One series: as literals. Many: a join, broadcast only while the table is small."""
    if not series:
        row = table.first()
        if row is None:
            raise ValueError("no complete rows to fit on")
        return df.withColumns({c: F.lit(row[c]) if not isinstance(row[c], list) else F.array(*map(F.lit, row[c])) for c in columns})
    right = table.select(*[F.col(c).alias(f"__k_{c}") for c in series], *columns)
    if count <= BROADCAST_SERIES:
        right = F.broadcast(right)
    cond = None
    for c in series:
        eq = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = eq if cond is None else cond & eq
    return df.join(right, cond, "left").drop(*[f"__k_{c}" for c in series])


def _halo(spec: ArxSpec) -> int:
    lags = max(spec.ar_lags or [0])
    if spec.ma_lags:
        lags = max(lags, max(spec.stage_one_lags) + max(spec.ma_lags))
    return max(1, lags + max(spec.difference_weights))


def _z(t: Timeline, column: str, spec: ArxSpec):
    """A column differenced as the model asks."""
    z = None
    for lag, w in spec.difference_weights.items():
        term = (F.col(column) if lag == 0 else F.lag(column, lag).over(t.window)) * w
        z = term if z is None else z + term
    return z


def _dot(beta: str, columns):
    out = F.lit(0.0)
    for i, c in enumerate(columns):
        out = out + F.element_at(beta, i + 1) * (F.col(c) if isinstance(c, str) else c)
    return out


def _stage_one_columns(spec: ArxSpec) -> list[str]:
    return (["__const"] if spec.intercept else []) + [f"__z{i}" for i in spec.stage_one_lags]


def _stage_two_columns(spec: ArxSpec) -> list[str]:
    return (["__const"] if spec.intercept else []) + [f"__z{i}" for i in spec.ar_lags] + [
        f"__e{i}" for i in spec.ma_lags
    ]


def _lagged(t: Timeline, df: DataFrame, spec: ArxSpec, target: str) -> DataFrame:
    z = df.withColumns({"__y": _z(t, target, spec), "__const": F.lit(1.0)})
    lags = sorted(set(spec.ar_lags) | (set(spec.stage_one_lags) if spec.ma_lags else set()))
    return z.withColumns({f"__z{i}": F.lag("__y", i).over(t.window) for i in lags})


def _with_shocks(t: Timeline, lagged: DataFrame, spec: ArxSpec) -> DataFrame:
    """Stage-one residuals and their lags; needs ``beta1``."""
    e = lagged.withColumn("__e0", F.col("__y") - _dot("beta1", _stage_one_columns(spec)))
    return e.withColumns({f"__e{i}": F.lag("__e0", i).over(t.window) for i in spec.ma_lags})


def _home(t: Timeline, df: DataFrame) -> DataFrame:
    return df.filter(HOME) if t.layout.chunked else df


def _errors_only(spec: ArxSpec) -> ArxSpec:
    return replace(spec, exog=())


def _outside(spec: ArxSpec):
    """The regressors' part of a row; needs ``beta``."""
    first = (1 if spec.intercept else 0) + len(spec.ar_lags) + len(spec.ma_lags)
    total = F.lit(0.0)
    for i, c in enumerate(spec.exog, start=1):
        total = total + F.element_at("beta", first + i) * F.col(c)
    return total


def _errors_model(model: ArxModel) -> ArxModel:
    """The model of the regression's errors, which are in column ``__v``."""
    own = len(model.spec.terms) - len(model.spec.exog)
    return replace(model, spec=_errors_only(model.spec), target="__v", table=model.table.withColumn("beta", F.slice("beta", 1, own)))


def _with_errors(df: DataFrame, model: ArxModel) -> DataFrame:
    data = _attach(df, model.table, model.series, ["beta"], model.count)
    return data.withColumn("__v", F.col(model.target) - _outside(model.spec)).drop("beta")


def _regression_fit(data: DataFrame, spec: ArxSpec, target: str, series, order, layout: Layout) -> ArxModel:
    """Regression whose errors follow the ARMA part: target and regressors are differenced alike.

    The weights come from the differenced regression, the ARMA terms from its errors.
    """
    means, names = _means(data, spec, target, series)
    means = means.persist()  # one row per series
    count = means.count()
    t = Timeline(_attach(data, means, series, names, count), layout, max(1, *spec.difference_weights))
    columns = [f"__x{i}" for i in range(len(spec.exog))]
    design = t.df.withColumns({"__y": _z(t, target, spec), "__const": F.lit(1.0), **{x: _z(t, c, spec) for x, c in zip(columns, spec.exog)}})
    constant = ["__const"] if spec.intercept else []
    weights = materialize(_fit_table(_home(t, design), [*constant, *columns], series, "beta", spec, means, count).drop("__all"))
    means.unpersist()
    lone = ArxModel(replace(spec, p=0, q=0, P=0, Q=0), series, order, target, weights, count)
    errors = arx_fit(_with_errors(data, lone), _errors_only(spec), "__v", series, order, layout)
    found = weights.select(*series, F.slice("beta", 1 + len(constant), len(columns)).alias("__weights"))
    table = _attach(errors.table, found, series, ["__weights"], count) if series else errors.table.crossJoin(F.broadcast(found))  # one row each
    table = table.withColumn("beta", F.concat("beta", "__weights")).drop("__weights")
    return ArxModel(spec, series, order, target, materialize(table), errors.count)


def arx_fit(df: DataFrame, spec: ArxSpec, target: str = TARGET, series=(), order=("date",),
            layout: Layout | None = None, chunk_rows: int | None = None) -> ArxModel:
    series, order = tuple(series), tuple(order)
    data = df.select(*dict.fromkeys([*series, *order, target, *spec.exog]))
    layout = layout or plan_layout(data, series, order, chunk_rows)
    if spec.exog:
        return _regression_fit(data, spec, target, series, order, layout)
    means, names = _means(data, spec, target, series)
    means = means.persist()  # one row per series
    count = means.count()
    one = None
    data = _attach(data, means, series, names, count)
    if spec.ma_lags:
        t = Timeline(data, layout, _halo(spec))
        one = _fit_table(_home(t, _lagged(t, t.df, spec, target)), _stage_one_columns(spec), series, "beta1", spec, means, count)
        # a few dozen numbers per series; kept so that later stages do not refit them
        one = one.persist()
        data = _attach(data, one, series, ["beta1"], count)
    t = Timeline(data, layout, _halo(spec))
    design = _lagged(t, t.df, spec, target)
    if spec.ma_lags:
        design = _with_shocks(t, design, spec)
    two = _fit_table(_home(t, design), _stage_two_columns(spec), series, "beta", spec, means, count)
    if one is not None:
        keys = list(series) or ["__all"]
        two = _attach(two, one.select(*keys, "beta1"), keys, ["beta1"], count)
    else:
        two = two.withColumn("beta1", F.array().cast("array<double>"))
    # a few dozen numbers per series, stored: what they were computed from is let go
    two = materialize(two.drop("__all"))
    for held in (one, means):
        if held is not None:
            held.unpersist()
    return ArxModel(spec, series, order, target, two, count)


def arx_residuals(df: DataFrame, model: ArxModel, layout: Layout | None = None,
                  chunk_rows: int | None = None) -> DataFrame:
    """In-sample ``fitted`` and ``residual`` in the level of the target; rows without enough history are NULL."""
    spec = model.spec
    if spec.exog:
        out = arx_residuals(_with_errors(df, model), _errors_model(model), layout, chunk_rows)
        return out.withColumn("fitted", F.col(model.target) - F.col("residual")).drop("__v")
    data = _attach(df, model.table, model.series, ["beta", "beta1"], model.count)
    t = Timeline(data, layout or plan_layout(df, model.series, model.order, chunk_rows), _halo(spec))
    design = _lagged(t, t.df, spec, model.target)
    if spec.ma_lags:
        design = _with_shocks(t, design, spec)
    residual = F.col("__y") - _dot("beta", _stage_two_columns(spec))
    out = design.withColumn("residual", residual).withColumn("fitted", F.col(model.target) - F.col("residual"))
    return t.close(out).drop("beta", "beta1")


def arx_forecast(history: DataFrame, future: DataFrame, model: ArxModel, name: str = "predicted",
                 layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Forecast for every row of ``future``, counted as the steps after each series' last history row.

    Series without a fit, or with fewer rows than the recursion looks back on, get NULL.

    The last few values and shocks of each series are one small row; ``forecast_steps`` carries them to any step, blocks
    of steps beside each other. Rows of ``future`` only meet the results in a join.
    """
    spec, series, order = model.spec, list(model.series), list(model.order)
    if spec.exog:
        past = _with_errors(history.select(*dict.fromkeys([*series, *order, model.target, *spec.exog])), model).select(*dict.fromkeys([*series, *order]), "__v")
        ahead = _attach(future, model.table, series, ["beta"], model.count).withColumn("outside_x", _outside(spec)).drop("beta")
        out = arx_forecast(past, ahead, _errors_model(model), name, layout, chunk_rows)
        return out.withColumn(name, F.col(name) + F.col("outside_x")).drop("outside_x")
    diff, ar, ma = spec.difference_weights, spec.ar_lags, spec.ma_lags
    depth = max([1, *ar, *ma]) + max(diff)

    # last values and shocks per series
    data = _attach(history.select(*dict.fromkeys([*series, *order, model.target, *spec.exog])), model.table,
                   series, ["beta", "beta1"], model.count)
    t = Timeline(data, layout or plan_layout(history, series, order, chunk_rows), _halo(spec))
    design = _lagged(t, t.df, spec, model.target)
    design = _with_shocks(t, design, spec) if ma else design.withColumn("__e0", F.lit(0.0))
    tail = _home(t, design.withColumns({"__left": t.total() - t.position()})).filter(F.col("__left") <= depth)
    missing = F.lit(float("nan"))
    row = F.struct("__left", F.coalesce(F.col(model.target).cast("double"), missing).alias("y"), F.coalesce("__e0", F.lit(0.0)).alias("e"))
    states = tail.groupBy(*series).agg(F.first("beta").alias("beta"), F.sort_array(F.collect_list(row)).alias("r"))
    states = states.filter((F.size("r") >= depth) & F.col("beta").isNotNull()).select(*series, "beta", F.col("r.y").alias("last"), F.col("r.e").alias("shocks"))
    return forecast_steps(materialize(states), future, series, order, _level_weights(spec), name)


def _level_weights(spec: ArxSpec):
    """Of a coefficient array: weights of the last levels, the constant, and weights of the last shocks."""
    skip, ar, ma, diff = (1 if spec.intercept else 0), spec.ar_lags, spec.ma_lags, spec.difference_weights

    def weigh(beta: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        own, steps, moving = np.zeros(max([0, *ar]) + 1), np.zeros(max(diff) + 1), np.zeros(max([0, *ma]))
        own[0] = 1.0
        own[ar] = -beta[skip:skip + len(ar)]
        steps[list(diff)] = list(diff.values())
        moving[[lag - 1 for lag in ma]] = beta[skip + len(ar):skip + len(ar) + len(ma)]
        return -np.convolve(own, steps)[1:], float(beta[0]) if skip else 0.0, moving

    return weigh
