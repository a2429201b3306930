"""ARMA fits by conditional sum of squares and forecasts in blocks, against sequential NumPy versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import same
from slotcast.operators import css as css_module, recurrence
from slotcast.operators.autoreg import ArxSpec, arx_fit, arx_forecast
from slotcast.operators.css import Css, CssModel, css_fit, css_forecast, css_residuals
from slotcast.operators.horizon import block_values
from slotcast.operators.recurrence import companion, newest, run

KW = dict(series=("series",), order=("at",))


def slow_shocks(spec, params, y, x):
    """Shocks one row after another; None where a row lacks something."""
    s = Css(spec)
    p = s.split(np.asarray(params, float))
    mean = p["mean"][0] if len(p["mean"]) else 0.0
    diff = spec.difference_weights
    n = len(y)
    u = np.full(n, np.nan)
    for t in range(max(diff), n):
        u[t] = sum(w * (y[t - k] - x[t - k] @ p["x"]) for k, w in diff.items()) - mean
    ar = {(i, j): (p["ar"][i - 1] if i else 1.0) * (-p["sar"][j - 1] if j and i else p["sar"][j - 1] if j else 1.0) for i in range(spec.p + 1) for j in range(spec.P + 1) if i or j}
    ma = {(i, j): (p["ma"][i - 1] if i else 1.0) * (p["sma"][j - 1] if j else 1.0) for i in range(spec.q + 1) for j in range(spec.Q + 1) if i or j}
    e, out = np.zeros(n), [None] * n
    for t in range(n):
        lags = [t - i - spec.m * j for i, j in ar]
        known = min([t, *lags]) >= 0 and np.isfinite(u[[t, *lags]]).all()
        r = u[t] - sum(w * u[t - i - spec.m * j] for (i, j), w in ar.items()) if known else 0.0
        e[t] = r - sum(w * e[t - i - spec.m * j] for (i, j), w in ma.items() if t - i - spec.m * j >= 0)
        if known:
            out[t] = e[t]
    return out


def slow_sum(spec, params, y, x):
    return sum(e * e for e in slow_shocks(spec, params, y, x) if e is not None)


def simulate(spec, params, n, seed, x=None):
    rng = np.random.default_rng(seed)
    s = Css(spec)
    ar, sar, ma, sma = s.polys(np.asarray(params, float))
    p = s.split(np.asarray(params, float))
    e = rng.normal(0, 1, n + 300)
    u = run(np.convolve(e, np.convolve(ma, sma))[:n + 300, None], -np.convolve(ar, sar)[1:])[:, 0]
    z = u + (p["mean"][0] if len(p["mean"]) else 0.0)
    steps = np.zeros(max(spec.difference_weights) + 1)
    for lag, w in spec.difference_weights.items():
        steps[lag] = w
    y = run(z[:, None], -steps[1:])[300:, 0]
    return y + (x @ p["x"] if x is not None else 0.0)


def frame(spark, many, x=None):
    rows = []
    for name, y in many.items():
        for i, v in enumerate(y):
            extra = tuple(map(float, x[name][i])) if x else (0.0, 0.0)
            rows.append((name, i, None if v is None or np.isnan(v) else float(v), *extra, "clash"))
    return spark.createDataFrame(rows, "series string, at long, value double, x0 double, x1 double, part string").repartition(4)


def table(model):
    return {r["series"]: (np.array(r["beta"], float), r["nobs"], r["sigma2"]) for r in model.table.collect()}


SPECS = [
    (ArxSpec(p=2, q=2), [1.5, 0.5, 0.2, 0.4, 0.25]),
    (ArxSpec(p=0, q=1, d=1, intercept=False), [-0.6]),
    (ArxSpec(p=1, q=1, P=1, D=1, Q=1, m=12, intercept=False), [0.5, 0.3, -0.4, -0.5]),
    (ArxSpec(p=1, q=1, exog=("x0", "x1")), [2.0, 0.6, 0.3, 1.2, -0.7]),
    (ArxSpec(p=2, q=0), [0.4, 0.5, -0.2]),
]


@pytest.mark.parametrize("spec,params", SPECS)
def test_shocks_and_derivatives_equal_a_sequential_loop(spec, params):
    rng = np.random.default_rng(1)
    n = 160
    x = rng.normal(0, 1, (n, len(spec.exog)))
    y = simulate(spec, params, n, 2, x if spec.exog else None)
    y[70] = np.nan
    s, params = Css(spec), np.array(params)
    diff = spec.difference_weights
    lagged = lambda c: sum(w * np.concatenate((np.full(k, np.nan), c[:n - k])) for k, w in diff.items())
    lead = np.full(s.reach, np.nan)
    z = np.concatenate((lead, lagged(y)))
    xs = np.column_stack([np.concatenate((lead, lagged(c))) for c in x.T]) if spec.exog else np.zeros((n + s.reach, 0))
    e, j, complete = s.shocks(params, z, xs, np.zeros(s.width))
    slow = slow_shocks(spec, params, y, x)
    assert [v is not None for v in slow] == complete.tolist()
    assert np.allclose(e[complete], [v for v in slow if v is not None])
    for k in range(s.count):
        h = 1e-6 * np.eye(s.count)[k]
        up, down = (np.array([v for v in slow_shocks(spec, params + d, y, x) if v is not None]) for d in (h, -h))
        assert np.allclose(j[complete, k], (up - down) / 2e-6, atol=1e-5)


@pytest.mark.parametrize("spec,params", SPECS)
def test_fit_is_the_least_sum_for_short_and_cut_series(spark, spec, params):
    rng = np.random.default_rng(5)
    sizes = {"a": 700, "b": 520}
    x = {k: rng.normal(0, 1, (n, 2)) for k, n in sizes.items()} if spec.exog else None
    many = {k: simulate(spec, params, n, i, x[k] if x else None) for i, (k, n) in enumerate(sizes.items())}
    many["short"] = np.array([1.0, 2.0])
    if x:
        x["short"] = np.zeros((2, 2))
    df = frame(spark, many, x)
    whole = css_fit(df, spec, "value", **KW)
    cut = css_fit(df, spec, "value", chunk_rows=150, **KW)
    one, other = table(whole), table(cut)
    assert np.isnan(one["short"][0]).all() == (one["short"][1] == 0)
    for k in sizes:
        beta, nobs, sigma2 = one[k]
        assert np.allclose(beta, other[k][0], atol=2e-5) and nobs == other[k][1] and sigma2 == pytest.approx(other[k][2], rel=1e-9)
        xs = x[k] if x else np.zeros((sizes[k], 0))
        least = slow_sum(spec, beta, many[k], xs)
        assert sigma2 * nobs == pytest.approx(least, rel=1e-9)
        for step in np.vstack((np.eye(len(beta)), -np.eye(len(beta)))) * 1e-3:
            assert slow_sum(spec, beta + step, many[k], xs) >= least * (1 - 1e-9)
        assert least <= slow_sum(spec, params, many[k], xs)


def test_three_folds_of_parts(spark, monkeypatch):
    """States handed down through several levels of parts give the same fit."""
    from slotcast.operators import recurrence

    monkeypatch.setattr(recurrence, "FAN", 3)
    spec, params = SPECS[0]
    df = frame(spark, {"a": simulate(spec, params, 900, 7)})
    same(css_fit(df, spec, "value", chunk_rows=30, **KW).coefficients(), css_fit(df, spec, "value", **KW).coefficients(), ["term"], tol=2e-5)


def test_autoregression_alone_is_least_squares(spark):
    spec, params = SPECS[4]
    y = simulate(spec, params, 600, 3)
    beta = table(css_fit(frame(spark, {"a": y}), spec, "value", **KW))["a"][0]
    c, p1, p2 = np.linalg.lstsq(np.column_stack((np.ones(598), y[1:-1], y[:-2])), y[2:], rcond=None)[0]
    assert np.allclose(beta, [c / (1 - p1 - p2), p1, p2])


def test_dependent_regressors_and_missing_values(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, 500)
    y = simulate(ArxSpec(p=1, q=0), [0.0, 0.5], 500, 9) + 3 * x
    y[[100, 333]] = np.nan
    df = frame(spark, {"a": y}, {"a": np.column_stack((x, 2 * x))})
    beta = table(css_fit(df, ArxSpec(p=1, q=1, exog=("x0", "x1")), "value", **KW))["a"][0]
    assert beta[3] + 2 * beta[4] == pytest.approx(3, abs=0.2)


@pytest.mark.parametrize("spec,params", SPECS)
def test_residuals_and_forecast_equal_a_sequential_loop(spark, spec, params):
    rng = np.random.default_rng(11)
    n, ahead = 260, 90
    x = rng.normal(0, 1, (n + ahead, 2))
    y = simulate(spec, params, n, 12, x[:n, :len(spec.exog)] if spec.exog else None)
    df = frame(spark, {"a": y, "b": y[:200]}, {"a": x[:n], "b": x[:200]})
    beta = spark.createDataFrame([("a", [float(v) for v in params], 1, 1.0), ("b", [float(v) for v in params], 1, 1.0), ("c", None, 0, None)], "series string, beta array<double>, nobs long, sigma2 double")
    model = CssModel(spec, ("series",), ("at",), "value", beta, 3)
    xs = x[:, :len(spec.exog)]
    for rows in (None, 70):
        got = css_residuals(df, model, chunk_rows=rows).toPandas().sort_values(["series", "at"])
        for k, size in (("a", n), ("b", 200)):
            want = pd.Series(slow_shocks(spec, params, y[:size], xs[:size]), dtype=float)
            assert np.allclose(got[got["series"] == k]["residual"].to_numpy(float), want, equal_nan=True)
    future = spark.createDataFrame([(k, size + i, *map(float, x[size + i]), i) for k, size in (("a", n), ("b", 200), ("c", 0)) for i in range(ahead)], "series string, at long, x0 double, x1 double, step int")
    for rows, steps in ((None, 16_384), (70, 30)):
        got = css_forecast(df, future, model, chunk_rows=rows, steps=steps).toPandas().sort_values(["series", "at"])
        assert got[got["series"] == "c"]["predicted"].isna().all() and got.columns.tolist() == ["series", "at", "x0", "x1", "step", "predicted"]
        for k, size in (("a", n), ("b", 200)):
            assert np.allclose(got[got["series"] == k]["predicted"].to_numpy(float), slow_forecast(spec, params, y[:size], xs, ahead))


def slow_forecast(spec, params, y, x, ahead):
    css = Css(spec)
    n = len(y)
    e = [0.0 if v is None else v for v in slow_shocks(spec, params, y, x[:n])] + [0.0] * ahead
    p = css.split(np.asarray(params, float))
    ar, sar, ma, sma = css.polys(np.asarray(params, float))
    steps = np.zeros(max(spec.difference_weights) + 1)
    for lag, w in spec.difference_weights.items():
        steps[lag] = w
    back, moving = np.convolve(np.convolve(ar, sar), steps), np.convolve(ma, sma)
    mean = (p["mean"][0] if len(p["mean"]) else 0.0) * np.convolve(ar, sar).sum()
    v = list(y - x[:n] @ p["x"])
    for t in range(n, n + ahead):
        v.append(mean - sum(back[j] * v[t - j] for j in range(1, len(back))) + sum(moving[j] * e[t - j] for j in range(1, len(moving))))
    return np.array(v[n:]) + x[n:n + ahead] @ p["x"]


def test_one_series_without_a_key(spark):
    spec, params = SPECS[3]
    x = np.random.default_rng(3).normal(0, 1, (430, 2))
    y = simulate(spec, params, 400, 4, x[:400])
    df = frame(spark, {"a": y}, {"a": x})
    one = css_fit(df.drop("series"), spec, "value", order=("at",), chunk_rows=100)
    assert np.allclose(one.table.first()["beta"], css_fit(df, spec, "value", **KW).table.first()["beta"], atol=2e-5)
    future = spark.createDataFrame([(400 + i, *map(float, x[400 + i])) for i in range(30)], "at long, x0 double, x1 double")
    got = css_forecast(df.drop("series"), future, one, chunk_rows=100, steps=7).orderBy("at").toPandas()["predicted"]
    assert np.allclose(got, slow_forecast(spec, one.table.first()["beta"], y, x, 30))
    assert css_residuals(df.drop("series"), one).filter("residual is not null").count() == 399


def test_empty_table(spark):
    spec, _ = SPECS[0]
    df = frame(spark, {"a": [1.0]}).limit(0)
    model = css_fit(df, spec, "value", **KW)
    assert model.table.count() == 0 and model.coefficients().count() == 0
    assert css_forecast(df, df.drop("value"), model).count() == 0


def test_regression_forecast_in_blocks_equals_one_block(spark):
    spec, params = SPECS[2]
    df = frame(spark, {"a": simulate(spec, params, 600, 1), "b": simulate(spec, params, 500, 2)})
    future = spark.createDataFrame([(k, 1000 + i) for k in "abc" for i in range(100)], "series string, at long")
    got = arx_forecast(df, future, arx_fit(df, spec, "value", **KW))
    assert got.filter("series = 'c' and predicted is not null").count() == 0 and got.filter("series <> 'c' and predicted is null").count() == 0


# --- the recurrence itself -------------------------------------------------------
@pytest.mark.parametrize("rows", [0, 1, 2, 5, 37, 400])
def test_run_equals_a_loop(rows):
    rng = np.random.default_rng(rows)
    w = np.array([0.5, 0.0, -0.3, 0.2])
    x, before = rng.normal(0, 1, (rows, 3)), rng.normal(0, 1, (4, 3))
    y = list(before[::-1])
    for t in range(rows):
        y.append(x[t] + sum(w[j] * y[-1 - j] for j in range(4)))
    assert np.allclose(run(x, w, before), np.array(y[4:]).reshape(rows, 3))
    end = newest(before, run(x, w, before))
    assert np.allclose(end, np.array(y[-4:])[::-1])
    zero = newest(np.zeros((4, 3)), run(x, w))
    assert np.allclose(end, zero + np.linalg.matrix_power(companion(w), rows) @ before)


def test_steps_ahead_equal_one_run():
    rng = np.random.default_rng(2)
    psi, moving = np.array([1.4, -0.5, 0.0, 0.05]), np.array([0.3, 0.0, 0.2])
    last, shocks = rng.normal(0, 1, 4), rng.normal(0, 1, 3)
    whole = block_values(psi, 0.7, moving, last, shocks, 0, 60)
    parts = [block_values(psi, 0.7, moving, last, shocks, first, min(13, 60 - first)) for first in range(0, 60, 13)]
    assert np.allclose(np.concatenate(parts), whole)
    assert np.isnan(block_values(psi, 0.7, moving, np.array([1.0, np.nan, 1, 1]), shocks, 0, 3)).all()


def test_a_step_is_taken_for_all_series_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    css = Css(ArxSpec(p=1, q=1, exog=("x",)))
    blocks = []
    for rows in rng.integers(500, 520, 40).tolist() + [1, 2, 30, 700]:
        z, x = rng.normal(5, 2, rows + css.reach), rng.normal(0, 1, (rows + css.reach, 1))
        z[:css.reach] = x[:css.reach] = np.nan
        if rows % 3 == 0:
            z[rows // 2] = np.nan
        blocks.append((z, x))
    alone = [css.fit_blocks([b])[0] for b in blocks]
    calls, plain = [], css_module.run_many
    monkeypatch.setattr(css_module, "run_many", lambda *a: calls.append(len(a[0])) or plain(*a))
    fits = css.fit_blocks(iter(blocks))
    # side by side as alone, to the last bit, and no more rounds than the longest fit of each length needs
    assert all(np.array_equal(a["best"], b["best"]) and a["rounds"] == b["rounds"] for a, b in zip(fits, alone))
    assert len(calls) <= 2 * 5 * max(f["rounds"] for f in fits) and max(calls) >= 20
    monkeypatch.setattr(css_module, "BATCH_ROWS", 1200)
    monkeypatch.setattr(css_module, "HELD_ROWS", 5000)
    assert all(np.array_equal(a["best"], b["best"]) for a, b in zip(css.fit_blocks(iter(blocks)), alone))


def test_states_of_parts_are_dealt_out_by_their_number(spark, monkeypatch):
    rows = [(s, p, 5, [1.0 + s, 0.5], [0.3]) for s in range(30) for p in range(4)] + [(None, 0, 5, [2.0, 1.0], [0.3])]
    ends = spark.createDataFrame(rows, "s long, part long, n long, end array<double>, params array<double>")
    weights = lambda p: ([np.array([p[0]]), np.array([0.5 * p[0]])], [1, 1])
    tasks, plain = [], recurrence.materialize
    monkeypatch.setattr(recurrence, "materialize", lambda df: tasks.append(df.rdd.getNumPartitions()) or plain(df))
    monkeypatch.setattr(recurrence, "TASK_PARTS", 10)
    got = {(r["s"], r["part"]): r["state"] for r in recurrence.incoming(ends, ["s"], weights).collect()}
    assert tasks == [13] and len(got) == 121 and got[None, 0] == [0.0, 0.0]
    for s in range(30):
        state = np.zeros(2)
        for p in range(4):
            assert np.allclose(got[s, p], state)
            state = np.array([1.0 + s, 0.5]) + np.array([0.3, 0.15]) ** 5 * state
