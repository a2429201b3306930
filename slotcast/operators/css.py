"""Seasonal ARMA models with regressors by conditional sum of squares, for one long series or for many.

The differenced target less mean and regressors, u_t, follows phi(L) Phi(L^m) u_t = theta(L) Theta(L^m) e_t. Parameters are
the factors' own (no free product lags), found together with mean and regression weights by Gauss-Newton steps on the sum
of squared shocks e_t. Shocks before the first row that has all its lags are zero.

A series is cut into blocks of consecutive rows, stored once as arrays (the only shuffle of the rows). Shocks and their
derivatives are linear recurrences, run block by block from zeros; the states at block starts follow from the blocks' ends
(``recurrence.incoming``), so no task sees a whole series. With w_t = e_t / (theta(L) Theta(L^m)), which is one recurrence
of twice the order, the shocks' derivatives by the moving-average parameters are moving sums of w_t. Each step sums one
small cross-product matrix per block.

Fits start from a two-step regression over all rows. Series of one block are fitted in the task that holds them, longer
ones take all blocks in every step.
Steps that don't lower the sum, and steps to a moving average that can't be inverted, are damped. Dependent regressors
share their effect. Rows with a missing value among those they look back on have no shock, enter the recurrence as 0 and
aren't counted; series without any complete row get NULL. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..schema import TARGET
from ..session import materialize
from .autoreg import BROADCAST_SERIES, ArxSpec, _z, arx_fit
from .horizon import STEPS, forecast_steps
from .recurrence import companion, incoming, newest, part_length, run_many
from .timeline import CHUNK, HOME, TOTAL, Layout, Timeline, plan_layout, tasks_for

BLOCK_ROWS = 65_536
# Rows of the blocks that are computed side by side.
BATCH_ROWS = 131_072
# Rows of the blocks among which those of about equal length are looked for.
HELD_ROWS = 1_048_576
ROUNDS = 60
# Part of the sum of squares that a further step may still promise when a fit ends.
TOLERANCE = 1e-14
# Sums of squares this close differ by rounding.
ROUNDING = 1e-13
START_DAMPING, LEAST_DAMPING, MOST_DAMPING = 1e-3, 1e-9, 1e9


def _poly(weights, step: int, sign: float) -> np.ndarray:
    """1 + sign * sum of weights at multiples of ``step``, by lag, for one series or for many (series, weights)."""
    weights = np.asarray(weights, float)
    out = np.zeros((*weights.shape[:-1], weights.shape[-1] * step + 1))
    out[..., 0] = 1.0
    out[..., step::step] = sign * weights
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of two lag polynomials of many series."""
    out = np.zeros((len(a), a.shape[1] + b.shape[1] - 1))
    for i in range(a.shape[1]):
        out[:, i:i + b.shape[1]] += a[:, i:i + 1] * b
    return out


def _applied(poly: np.ndarray, columns: np.ndarray, lag: int, rows: int) -> np.ndarray:
    """The lag polynomials (series, lags) on the last ``rows`` entries of each series' column, ``lag`` rows earlier."""
    out = np.zeros((len(columns), rows))
    for j in np.flatnonzero(poly.any(axis=0)):
        end = columns.shape[1] - lag - j
        out += poly[:, j:j + 1] * columns[:, end - rows:end]
    return out


class Css:
    """The sum of squares of one model: what a block needs of others, and what it adds to the sums."""

    def __init__(self, spec: ArxSpec):
        self.spec = spec
        self.parts = [("mean", int(spec.intercept)), ("ar", spec.p), ("sar", spec.P), ("ma", spec.q), ("sma", spec.Q), ("x", len(spec.exog))]
        self.count = sum(n for _, n in self.parts)
        self.reach = spec.p + spec.m * spec.P          # rows before a block that its inputs look back on
        self.order = spec.q + spec.m * spec.Q
        self.linear = self.count - spec.q - spec.Q     # derivatives that are recurrences of known inputs
        self.width = 2 * self.order + self.order * self.linear

    @property
    def names(self) -> list[str]:
        out = []
        for name, n in self.parts:
            if name == "mean":
                out += ["mean"] * n
            elif name == "x":
                out += [f"x_{c}" for c in self.spec.exog]
            else:
                out += [f"{name}_{i}" for i in range(1, n + 1)]
        return out

    def split(self, params: np.ndarray) -> dict[str, np.ndarray]:
        edges = np.cumsum([0, *(n for _, n in self.parts)])
        return {name: params[..., a:b] for (name, _), a, b in zip(self.parts, edges[:-1], edges[1:])}

    def polys(self, params: np.ndarray) -> tuple[np.ndarray, ...]:
        """Factors of the autoregression and of the moving average, by lag."""
        p, m = self.split(params), self.spec.m
        return _poly(p["ar"], 1, -1.0), _poly(p["sar"], m, -1.0), _poly(p["ma"], 1, 1.0), _poly(p["sma"], m, 1.0)

    def recurrences(self, params: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """The recurrence of w (twice the moving average) and that of the linear derivatives, with their column counts."""
        _, _, ma, sma = self.polys(params)
        both = np.convolve(ma, sma)
        return [-np.convolve(both, both)[1:], -both[1:]], [1, self.linear]

    def invertible(self, params: np.ndarray) -> bool:
        p = self.split(params)
        return all(not len(w) or (abs(w[0]) if len(w) == 1 else np.abs(np.linalg.eigvals(companion(-w))).max()) < 1 - 1e-6 for w in (p["ma"], p["sma"]))

    def inputs(self, params: np.ndarray, z: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input of the shocks, inputs of the linear derivatives, and which rows are complete.

        For many blocks of equal length: params (blocks, parameters), z (blocks, rows) and x (blocks, rows, regressors), the
        latter two led by ``reach`` rows.
        """
        ar, sar, _, _ = self.polys(params)
        p, rows = self.split(params), z.shape[1] - self.reach
        u = z - (p["mean"] if self.spec.intercept else 0.0) - (x @ p["x"][:, :, None])[:, :, 0]
        both = _product(ar, sar)
        shock = _applied(both, u, 0, rows)
        derived = []
        if self.spec.intercept:
            derived.append(np.repeat(-both.sum(axis=1)[:, None], rows, axis=1))
        derived += [-_applied(sar, u, i, rows) for i in range(1, self.spec.p + 1)]
        derived += [-_applied(ar, u, self.spec.m * j, rows) for j in range(1, self.spec.P + 1)]
        derived += [-_applied(both, x[:, :, c], 0, rows) for c in range(x.shape[2])]
        # all lags of the product count, also where a parameter is zero just now
        lags = _product(_poly(np.ones((1, self.spec.p)), 1, 1.0), _poly(np.ones((1, self.spec.P)), self.spec.m, 1.0))
        whole = np.isfinite(z) & np.isfinite(x).all(axis=2)
        complete = _applied(lags, (~whole).astype(float), 0, rows) == 0
        columns = np.stack(derived, axis=2) if derived else np.zeros((len(z), rows, 0))
        shock[~complete] = 0.0
        columns[~complete] = 0.0
        return shock, columns, complete

    def weights(self, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weights of both recurrences of many blocks."""
        _, _, ma, sma = self.polys(params)
        both = _product(ma, sma)
        return -_product(both, both)[:, 1:], -both[:, 1:]

    def ends(self, params: np.ndarray, z: np.ndarray, x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Flat last values of the recurrences run from zeros, of blocks with ``rows`` rows before the filled-up ones."""
        shock, columns, _ = self.inputs(params, z, x)
        twice, once = self.weights(params)
        w, derived = run_many(shock[:, :, None], twice), run_many(columns, once)
        early = np.zeros((2 * self.order, 1)), np.zeros((self.order, self.linear))
        return [np.concatenate((newest(early[0], a[:n]).ravel(), newest(early[1], b[:n]).ravel())) for n, a, b in zip(rows, w, derived)]

    def shocks(self, params: np.ndarray, z: np.ndarray, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``shocks_many`` for one block."""
        e, j, complete = self.shocks_many(params[None], z[None], x[None], state[None])
        return e[0], j[0], complete[0]

    def shocks_many(self, params: np.ndarray, z: np.ndarray, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shocks of the blocks' rows, their derivatives by all parameters in order, and which rows are complete."""
        _, _, ma, sma = self.polys(params)
        shock, columns, complete = self.inputs(params, z, x)
        if not self.order:
            return shock, self._ordered(columns, np.zeros((*shock.shape, 0))), complete
        twice, once = self.weights(params)
        k, (blocks, rows) = 2 * self.order, shock.shape
        before = state[:, :k].reshape(blocks, k, 1)
        w = np.concatenate((before[:, ::-1, 0], run_many(shock[:, :, None], twice, before)[:, :, 0]), axis=1)
        moving = [-_applied(sma, w, i, rows) for i in range(1, self.spec.q + 1)] + [-_applied(ma, w, self.spec.m * j, rows) for j in range(1, self.spec.Q + 1)]
        derived = run_many(columns, once, state[:, k:].reshape(blocks, self.order, self.linear))
        return _applied(_product(ma, sma), w, 0, rows), self._ordered(derived, np.stack(moving, axis=2)), complete

    def _ordered(self, linear: np.ndarray, moving: np.ndarray) -> np.ndarray:
        ahead = self.linear - len(self.spec.exog)
        return np.concatenate((linear[:, :, :ahead], moving, linear[:, :, ahead:]), axis=2)

    def sums(self, params: np.ndarray, z: np.ndarray, x: np.ndarray, state: np.ndarray) -> list[np.ndarray]:
        """Of each block: flat cross products of (derivatives, shock), then the number of complete rows."""
        e, j, complete = self.shocks_many(params, z, x, state)
        out = []
        for full, rows in zip(np.concatenate((j, e[:, :, None]), axis=2), complete):
            full = full[rows]
            out.append(np.append((full.T @ full).ravel(), len(full)))
        return out

    def batches(self, blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of about equal length side by side: their numbers, z and x filled up with missing rows, and their own rows.

        Only blocks that the recurrences cut alike meet, so that company doesn't change a block's figures.
        """
        alike: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        held = 0
        for i, (z, x) in enumerate(blocks):
            alike.setdefault(part_length(len(z) - self.reach, 1), []).append((i, z, x))
            held += len(z)
            if held >= HELD_ROWS:
                yield from self._side_by_side(alike)
                alike, held = {}, 0
        yield from self._side_by_side(alike)

    def _side_by_side(self, alike: dict[int, list[tuple[int, np.ndarray, np.ndarray]]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        for group in alike.values():
            longest = max(len(z) for _, z, _ in group)
            size = max(1, BATCH_ROWS // max(1, longest))
            for at in range(0, len(group), size):
                some = group[at:at + size]
                z = np.full((len(some), longest), np.nan)
                x = np.full((len(some), longest, len(self.spec.exog)), np.nan)
                for j, (_, own, regressors) in enumerate(some):
                    z[j, :len(own)], x[j, :len(own)] = own, regressors
                yield [i for i, _, _ in some], z, x, np.array([len(own) - self.reach for _, own, _ in some])

    # -- steps ---------------------------------------------------------------
    def step(self, fit: dict) -> dict:
        """Takes in the sums at ``trial`` and sets the next trial, or ends the fit."""
        k = self.count
        new, old = fit["sums"], fit.get("best_sums")
        value = new[-2] if np.isfinite(new).all() else np.inf
        if old is None or value <= old[-2] * (1 + ROUNDING):
            fit["best"], fit["best_sums"] = fit["trial"], new
            fit["damping"] = max(fit["damping"] / 10, LEAST_DAMPING)
        else:
            fit["damping"] *= 10
        fit["rounds"] += 1
        best = fit["best_sums"]
        if not best[-1] or not np.isfinite(best).all():
            return {**fit, "done": True}
        m = best[:-1].reshape(k + 1, k + 1)
        gram, slope = m[:k, :k], m[:k, k]
        scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
        scaled, down = gram / np.outer(scale, scale), slope / scale
        full = np.linalg.lstsq(scaled, down, rcond=1e-11)[0] if k else np.zeros(0)
        if not k or down @ full <= TOLERANCE * m[k, k] or fit["rounds"] >= ROUNDS or fit["damping"] > MOST_DAMPING:
            return {**fit, "done": True}
        while True:
            # with the least damping a step is the plain one, also along dependent columns
            move = full if fit["damping"] <= LEAST_DAMPING else np.linalg.lstsq(scaled + fit["damping"] * np.eye(k), down, rcond=1e-11)[0]
            fit["trial"] = fit["best"] - move / scale
            if self.invertible(fit["trial"]):
                return {**fit, "done": False}
            fit["damping"] *= 10
            if fit["damping"] > MOST_DAMPING:
                return {**fit, "done": True}

    def start(self, z: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Two regressions: of the target, then of its errors on their own and a long autoregression's lags."""
        spec, params = self.spec, np.zeros(self.count)
        rows = len(z) - self.reach
        part = self.split(params)  # views
        z, x = z[self.reach:], x[self.reach:]
        whole = np.isfinite(z) & np.isfinite(x).all(axis=1)
        if whole.sum() <= self.count + 1:
            return params
        design = np.column_stack(([np.ones(rows)] if spec.intercept else []) + [x])
        u = np.where(whole, z, 0.0)
        if design.shape[1]:
            weights = np.linalg.lstsq(design[whole], z[whole], rcond=1e-11)[0]
            u = np.where(whole, z - np.where(np.isfinite(design), design, 0.0) @ weights, 0.0)
            part["mean"][:], part["x"][:] = weights[:int(spec.intercept)], weights[int(spec.intercept):]
        seasonal = [spec.m * j for j in range(1, max(spec.P, spec.Q) + 1)]
        depth = sorted({*range(1, max(10, 2 * (spec.p + spec.q)) + 1), *seasonal, *(s + 1 for s in seasonal)})
        skip = depth[-1] + spec.q + spec.m * spec.Q
        if rows - skip <= 2 * (len(depth) + self.count):
            return params
        lagged = lambda c, lags, low: np.column_stack([c[low - j:rows - j] for j in lags])
        e = np.zeros(rows)
        first = lagged(u, depth, depth[-1])
        e[depth[-1]:] = u[depth[-1]:] - first @ np.linalg.lstsq(first, u[depth[-1]:], rcond=1e-11)[0]
        own = [*range(1, spec.p + 1), *(spec.m * j for j in range(1, spec.P + 1))]
        shocks = [*range(1, spec.q + 1), *(spec.m * j for j in range(1, spec.Q + 1))]
        if own or shocks:
            second = np.hstack([lagged(c, lags, skip) for c, lags in ((u, own), (e, shocks)) if lags])
            found = np.linalg.lstsq(second, u[skip:], rcond=1e-11)[0]
            part["ar"][:], part["sar"][:] = found[:spec.p], found[spec.p:spec.p + spec.P]
            part["ma"][:], part["sma"][:] = found[len(own):len(own) + spec.q], found[len(own) + spec.q:]
        return self.shrunk(params)

    def shrunk(self, params: np.ndarray) -> np.ndarray:
        """Starting values whose moving averages can be inverted."""
        params = np.where(np.isfinite(params), params, 0.0)
        part = self.split(params)  # views
        for name in ("ma", "sma"):
            radius = np.abs(np.linalg.eigvals(companion(-part[name]))).max() if len(part[name]) else 0.0
            if radius >= 0.95:
                part[name][:] *= (0.9 / radius) ** np.arange(1, len(part[name]) + 1)
        return params

    def from_regression(self, beta: np.ndarray) -> np.ndarray:
        """Starting values from the two-step regression's coefficients of product lags."""
        spec, params = self.spec, np.zeros(self.count)
        part, given = self.split(params), dict(zip(spec.terms, beta))  # views
        part["ar"][:] = [given[f"ar_{i}"] for i in range(1, spec.p + 1)]
        part["sar"][:] = [given[f"ar_{spec.m * j}"] for j in range(1, spec.P + 1)]
        part["ma"][:] = [given[f"ma_{i}"] for i in range(1, spec.q + 1)]
        part["sma"][:] = [given[f"ma_{spec.m * j}"] for j in range(1, spec.Q + 1)]
        part["x"][:] = [given[f"x_{c}"] for c in spec.exog]
        if spec.intercept:
            left = 1.0 - sum(given[f"ar_{i}"] for i in spec.ar_lags)
            part["mean"][:] = given["const"] / left if abs(left) > 1e-6 else 0.0
        return self.shrunk(params)

    def fit_blocks(self, blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
        """The fits of blocks that are whole series; a step is taken for many of them at once."""
        out = {}
        with np.errstate(all="ignore"):
            for numbers, z, x, rows in self.batches(blocks):
                fits = [{"trial": self.start(z[j, :self.reach + n], x[j, :self.reach + n]), "damping": START_DAMPING, "rounds": 0, "done": False} for j, n in enumerate(rows)]
                left = list(range(len(fits)))
                while left:
                    trials = np.array([fits[j]["trial"] for j in left])
                    for j, sums in zip(left, self.sums(trials, z, x, np.zeros((len(left), self.width)))):
                        fits[j] = self.step({**fits[j], "sums": sums})
                    keep = [n for n, j in enumerate(left) if not fits[j]["done"]]
                    if len(keep) < len(left):
                        left, z, x = [left[n] for n in keep], z[keep], x[keep]
                out.update(zip(numbers, fits))
        return [out[i] for i in range(len(out))]


@dataclass
class CssModel:
    """Parameters per series: ``beta`` in the order of ``terms``, ``nobs`` rows with a shock, ``sigma2`` their mean square."""

    spec: ArxSpec
    series: tuple[str, ...]
    order: tuple[str, ...]
    target: str
    table: DataFrame            # series..., beta, nobs, sigma2
    count: int

    @property
    def terms(self) -> list[str]:
        return Css(self.spec).names

    def coefficients(self) -> DataFrame:
        """Long form: series..., term, value."""
        if not self.terms:
            return self.table.select(*self.series, F.lit("").alias("term"), F.lit(0.0).alias("value")).limit(0)
        names = F.array(*[F.lit(t) for t in self.terms])
        return self.table.select(*self.series, F.explode(F.arrays_zip(names.alias("term"), F.col("beta").alias("value"))).alias("t")).select(
            *self.series, F.col("t.term").alias("term"), F.col("t.value").alias("value")
        )


ALL = "__all"


def _keys(series) -> list[str]:
    return list(series) or [ALL]


def _blocks(df: DataFrame, spec: ArxSpec, target: str, series, order, layout: Layout) -> DataFrame:
    """Rows (keys, part, n, first, total, v): a block's n rows after the rows before it, in row order."""
    model = Css(spec)
    t = Timeline(df, layout, max(1, model.reach + max(spec.difference_weights)))
    columns = {"__v0": _z(t, target, spec), **{f"__v{i}": _z(t, c, spec) for i, c in enumerate(spec.exog, start=1)}}
    rows = t.df.withColumns({"__pos": t.position(), "__sum": t.total(), **columns})
    own = F.col(HOME) if layout.chunked else F.lit(True)
    part = F.col(CHUNK) if layout.chunked else F.lit(0).cast("long")
    rows = rows.select(*(series or [F.lit(0).alias(ALL)]), part.alias("part"), own.alias("__own"), "__pos", "__sum", *[F.col(c).cast("double").alias(c) for c in columns])
    packed = rows.groupBy(*_keys(series), "part").agg(
        F.count_if("__own").alias("n"), F.min(F.when(F.col("__own"), F.col("__pos"))).alias("first"), F.max("__sum").alias("total"),
        F.sort_array(F.collect_list(F.struct("__pos", *columns))).alias("v"),
    )
    return materialize(packed)


def _arrays(batch: pa.RecordBatch, reach: int, regressors: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Target and regressors of each block in a batch, led by ``reach`` rows (missing ones before the series begins)."""
    lists = batch.column("v")
    edges, fields = lists.offsets.to_numpy(), lists.values
    for a, b, n in zip(edges[:-1].tolist(), edges[1:].tolist(), batch.column("n").to_pylist()):
        a = max(a, b - n - reach)
        v = np.full((n + reach, 1 + regressors), np.nan)
        for i in range(1 + regressors):
            v[n + reach - (b - a):, i] = fields.field(i + 1).slice(a, b - a).to_numpy(zero_copy_only=False)
        yield v[:, 0], v[:, 1:]


def _lists(values) -> pa.Array:
    return pa.array([None if v is None else np.asarray(v, float) for v in values], pa.list_(pa.float64()))


def _joined(left: DataFrame, right: DataFrame, keys, count: int) -> DataFrame:
    """Rows of ``left`` with the columns of ``right``, equal keys (missing ones too); broadcast only while ``right`` is small."""
    on = [F.col(c).alias(f"__k_{c}") for c in keys]
    right = right.select(*on, *[c for c in right.columns if c not in keys])
    cond = None
    for c in keys:
        eq = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = eq if cond is None else cond & eq
    return left.join(F.broadcast(right) if count <= BROADCAST_SERIES else right, cond).drop(*[f"__k_{c}" for c in keys])


def _named(df: DataFrame, keys) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{c}` {kinds[c]}" for c in keys)


def _states(data: DataFrame, model: Css, keys) -> DataFrame:
    """Adds ``state``, the recurrences' values before each block, to blocks with their series' ``params``."""
    if not model.order:
        return data.withColumn("state", F.array().cast("array<double>"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            params = batch.column("params").to_pylist()
            with np.errstate(all="ignore"):
                found = [None] * len(params)
                for numbers, z, x, rows in model.batches(_arrays(batch, model.reach, len(model.spec.exog))):
                    for i, end in zip(numbers, model.ends(np.array([params[i] for i in numbers], float), z, x, rows)):
                        found[i] = end
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "part", "n")), _lists(found), batch.column("params")], names=[*keys, "part", "n", "end", "params"])

    last = data.mapInArrow(ends, f"{_named(data, keys)}, part long, n long, end array<double>, params array<double>")
    states = incoming(materialize(last), list(keys), model.recurrences)
    right = states.select(*[F.col(c).alias(f"__k_{c}") for c in (*keys, "part")], "state")
    cond = F.col("part") == F.col("__k_part")
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return data.join(right, cond).drop(*[f"__k_{c}" for c in (*keys, "part")])


FIT = "best array<double>, best_sums array<double>, trial array<double>, damping double, rounds int, done boolean"


def _fit_rows(keys: list[pa.Array], names, fits: list[dict]) -> pa.RecordBatch:
    columns = [_lists([f.get(c) for f in fits]) for c in ("best", "best_sums", "trial")]
    columns += [pa.array([f["damping"] for f in fits], pa.float64()), pa.array([f["rounds"] for f in fits], pa.int32()), pa.array([f["done"] for f in fits], pa.bool_())]
    return pa.RecordBatch.from_arrays([*keys, *columns], names=[*names, "best", "best_sums", "trial", "damping", "rounds", "done"])


def css_fit(df: DataFrame, spec: ArxSpec, target: str = TARGET, series=(), order=("date",), layout: Layout | None = None,
            chunk_rows: int | None = None) -> CssModel:
    """Fits ``spec`` to every series."""
    series, order = tuple(series), tuple(order)
    model, keys = Css(spec), _keys(series)
    data = df.select(*dict.fromkeys([*series, *order, target, *spec.exog]))
    layout = layout or plan_layout(data, series, order, chunk_rows or BLOCK_ROWS)
    blocks = _blocks(data, spec, target, series, order, layout)
    named = _named(blocks, keys)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = model.fit_blocks(_arrays(batch, model.reach, len(spec.exog)))
            yield _fit_rows([batch.column(c) for c in keys], keys, fits)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trials = [model.from_regression(np.asarray(b, float)) for b in batch.column("beta").to_pylist()]
            fits = [{"trial": t, "damping": START_DAMPING, "rounds": 0, "done": False} for t in trials]
            yield _fit_rows([batch.column(c) for c in keys], keys, fits)

    # a fit takes far longer than reading its rows: dealt out by rows, not by bytes
    fits = blocks.filter("n = total").repartition(tasks_for(layout.rows), *keys).mapInArrow(alone, f"{named}, {FIT}")
    long = blocks.filter("n < total")
    if layout.chunked:
        heads = materialize(long.filter("part = 0").select(*keys))
        rows = _joined(data, heads, keys, heads.count()) if series else data
        two = arx_fit(rows, spec, target, series, order, layout).table
        two = two.select(*(series or [F.lit(0).alias(ALL)]), "beta")
        fits = fits.unionByName(two.mapInArrow(begin, f"{named}, {FIT}"))
    fits = materialize(fits)
    count = fits.count()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            params, states = batch.column("params").to_pylist(), batch.column("state").to_pylist()
            found = [None] * len(params)
            with np.errstate(all="ignore"):
                for numbers, z, x, _ in model.batches(_arrays(batch, model.reach, len(spec.exog))):
                    some = model.sums(np.array([params[i] for i in numbers], float), z, x, np.array([states[i] for i in numbers], float))
                    for i, g in zip(numbers, some):
                        found[i] = g
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), _lists(found)], names=[*keys, "sums"])

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                for c in ("best", "best_sums", "trial", "sums"):
                    r[c] = None if r[c] is None else np.asarray(r[c], float)
            yield _fit_rows([batch.column(c) for c in keys], keys, [model.step(r) for r in rows])

    while fits.filter("not done").limit(1).count():
        open_ = fits.filter("not done")
        given = _states(_joined(long, open_.select(*keys, F.col("trial").alias("params")), keys, count), model, keys)
        parts = given.mapInArrow(sums, f"{named}, sums array<double>").select(*keys, F.posexplode("sums").alias("i", "g"))
        summed = parts.groupBy(*keys, "i").agg(F.sum("g").alias("g")).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "g"))).alias("s"))
        moved = _joined(summed.select(*keys, F.col("s.g").alias("sums")), open_, keys, count).mapInArrow(advance, f"{named}, {FIT}")
        fits = materialize(fits.filter("done").unionByName(moved))
    size = (model.count + 1) ** 2
    nobs = F.element_at("best_sums", size + 1).cast("long")
    table = fits.select(*series, F.when(nobs > 0, F.col("best")).alias("beta"), nobs.alias("nobs"), F.when(nobs > 0, F.element_at("best_sums", size) / nobs).alias("sigma2"))
    return CssModel(spec, series, order, target, materialize(table), count)


def _shocks(df: DataFrame, model: CssModel, layout: Layout, late: int | None = None) -> DataFrame:
    """Rows (keys, pos, e): every complete row's shock; with ``late`` only those of the last so many rows of a series."""
    css, keys = Css(model.spec), _keys(model.series)
    blocks = _blocks(df, model.spec, model.target, model.series, model.order, layout)
    table = model.table if model.series else model.table.withColumn(ALL, F.lit(0))
    params = table.filter("beta is not null").select(*keys, F.col("beta").alias("params"))
    given = _states(_joined(blocks, params, keys, model.count), css, keys)
    if late is not None:
        given = given.filter(F.col("first") + F.col("n") > F.col("total") - late)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            params, states = batch.column("params").to_pylist(), batch.column("state").to_pylist()
            out = [None] * len(params)
            for numbers, z, x, rows in css.batches(_arrays(batch, css.reach, len(css.spec.exog))):
                e, _, complete = css.shocks_many(np.array([params[i] for i in numbers], float), z, x, np.array([states[i] for i in numbers], float))
                for i, n, values in zip(numbers, rows, np.where(complete, e, np.nan)):
                    out[i] = values[:n]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "first", "total")), _lists(out)], names=[*keys, "first", "total", "e"])

    found = given.mapInArrow(make, f"{_named(given, keys)}, first long, total long, e array<double>")
    found = found.select(*keys, "first", "total", F.posexplode("e").alias("at", "e")).select(*keys, "total", (F.col("first") + F.col("at")).alias("pos"), "e")
    if late is not None:
        found = found.filter(F.col("pos") >= F.col("total") - late)
    return found.filter(~F.isnan("e")).drop("total")


def css_residuals(df: DataFrame, model: CssModel, layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Rows with ``fitted`` and ``residual`` in the level of the target; rows that lack something to look back on are NULL."""
    layout = layout or plan_layout(df, model.series, model.order, chunk_rows or BLOCK_ROWS)
    e = _shocks(df, model, layout)
    t = Timeline(df, layout)
    rows = t.close(t.df.withColumn("residual_at", t.position()))
    cond = F.col("residual_at") == F.col("__e_pos")
    for c in model.series:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__e_{c}"))
    e = e.select(*[F.col(c).alias(f"__e_{c}") for c in model.series], F.col("pos").alias("__e_pos"), F.col("e").alias("residual"))
    out = rows.join(e, cond, "left").drop("residual_at", "__e_pos", *[f"__e_{c}" for c in model.series])
    return out.withColumn("fitted", F.col(model.target) - F.col("residual"))


def level_weights(spec: ArxSpec):
    """Of parameters: weights of the last levels, the constant, and weights of the last shocks."""
    css = Css(spec)
    steps = np.zeros(max(spec.difference_weights) + 1)
    for lag, w in spec.difference_weights.items():
        steps[lag] = w

    def weigh(params: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        ar, sar, ma, sma = css.polys(params)
        both = np.convolve(ar, sar)
        mean = css.split(params)["mean"]
        return -np.convolve(both, steps)[1:], float(both.sum() * mean[0]) if len(mean) else 0.0, np.convolve(ma, sma)[1:]

    return weigh


def css_forecast(history: DataFrame, future: DataFrame, model: CssModel, name: str = "predicted", layout: Layout | None = None,
                 chunk_rows: int | None = None, steps: int = STEPS) -> DataFrame:
    """Forecast for every row of ``future``, counted as the steps after each series' last history row.

    The regression's errors are forecast, the regressors' part of a row is added to them; regressors that are missing give
    NULL, as do series without a fit, or with a missing value among the last ones that the recursion looks back on.
    """
    spec, series, order = model.spec, list(model.series), list(model.order)
    css, keys = Css(spec), _keys(series)
    data = history.select(*dict.fromkeys([*series, *order, model.target, *spec.exog]))
    layout = layout or plan_layout(data, series, order, chunk_rows or BLOCK_ROWS)
    at = css.count - len(spec.exog)
    outside = F.lit(0.0)
    for i, c in enumerate(spec.exog, start=1):
        outside = outside + F.element_at("beta", at + i) * F.col(c)
    table = model.table if series else model.table.withColumn(ALL, F.lit(0))
    table = table.filter("beta is not null").select(*keys, "beta")
    depth = css.reach + max(spec.difference_weights)
    t = Timeline(data, layout)
    tail = t.df.withColumn("left", t.total() - t.position()).filter(F.col("left") <= max(depth, 1))
    tail = _joined(tail if series else tail.withColumn(ALL, F.lit(0)), table, keys, model.count)
    last = tail.groupBy(*keys, "beta").agg(F.sort_array(F.collect_list(F.struct("left", (F.col(model.target) - outside).alias("v")))).alias("r"))
    # a missing value must stay in its place
    last = last.select(*keys, "beta", F.transform("r", lambda x: F.coalesce(x["v"], F.lit(float("nan")))).alias("last")).filter(F.size("last") >= depth)
    if css.order:
        e = _shocks(data, model, layout, css.order)
        ends = t.df.groupBy(*(series or [F.lit(0).alias(ALL)])).agg(F.max(TOTAL).alias("total")) if layout.chunked else data.groupBy(*(series or [F.lit(0).alias(ALL)])).agg(F.count(F.lit(1)).alias("total"))
        e = _joined(e, ends, keys, model.count).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct((F.col("total") - F.col("pos")).cast("int"), "e"))).alias("e"))
        # a row without a shock counts as 0
        whole = F.transform(F.sequence(F.lit(1), F.lit(css.order)), lambda i: F.coalesce(F.try_element_at("e", i), F.lit(0.0)))
        state = _joined(last, e.select(*keys, whole.alias("shocks")), keys, model.count)
    else:
        state = last.withColumn("shocks", F.array().cast("array<double>"))
    state = materialize(state)
    out = forecast_steps(state if series else state.drop(ALL), future, series, order, level_weights(spec), "__errors", max(steps, css.order + 1))
    if not spec.exog:
        return out.withColumnRenamed("__errors", name)
    if series:
        weights = model.table.select(*[F.col(c).alias(f"__k_{c}") for c in series], "beta")
        cond = None
        for c in series:
            eq = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
            cond = eq if cond is None else cond & eq
        out = out.join(F.broadcast(weights) if model.count <= BROADCAST_SERIES else weights, cond, "left").drop(*[f"__k_{c}" for c in series])
    else:
        row = model.table.first()
        out = out.withColumn("beta", F.array(*map(F.lit, row["beta"])) if row and row["beta"] else F.lit(None).cast("array<double>"))
    return out.withColumn(name, F.col("__errors") + outside).drop("__errors", "beta")
