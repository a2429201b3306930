import numpy as np
import pandas as pd
import pytest
from conftest import same
from pyspark.sql import functions as F

from slotcast import (
    ArxSpec, Calibrator, LinearModel, adf_test, align_predictions, arx_fit, arx_forecast, arx_residuals, assign_regimes,
    best_epoch, bounds_list, calibrate_apply, calibrate_fit, cv_summary, early_stop_select, error_metrics, fit_regimes,
    fit_ridge, fit_scaler, fold_bounds, kmeans_elbow, overfit_gap, plan_layout, regime_summary, scale_test, scale_train,
    score_windows, sigmoid_temperature, walk_forward_cv, walk_forward_folds,
)
from slotcast.operators.unitroot import mackinnon_p
from slotcast.schema import CORE, TRAIN_SCHEMA

KW = dict(series=("series",), order=("ts", "id"))


# --- scaling and regimes ------------------------------------------------------
@pytest.fixture(scope="module")
def scaled(train, test_table):
    stats = fit_scaler(train, CORE)
    return scale_train(train, stats, CORE), scale_test(test_table, stats, CORE), stats


def test_scaled_train_is_standard(scaled, train_pd):
    got = scaled[0].toPandas()
    for c in (*CORE, "spread_scaled"):
        assert abs(got[c].mean()) < 0.01 and abs(got[c].std(ddof=0) - 1) < 1e-9
    assert np.allclose(np.sort(got["spread"]), np.sort(train_pd["spread"]))


def test_test_table_uses_train_statistics(scaled, test_table):
    _, test, stats = scaled
    raw, got = test_table.orderBy("ID").toPandas(), test.orderBy("ID").toPandas()
    assert np.allclose(got["wind"], (raw["wind"] - stats["wind"][0]) / stats["wind"][1]) and "spread_scaled" not in got


def test_constant_column_gets_scale_one(train):
    assert fit_scaler(train.withColumn("flat", F.lit(4.0)), ("flat",))["flat"] == (4.0, 1.0)


def test_regimes(scaled):
    train, test, _ = scaled
    regimes = fit_regimes(train, inits=3)
    assert list(regimes.centres) == sorted(regimes.centres)
    got = assign_regimes(train, regimes).toPandas()
    x = got[list(CORE)].to_numpy()
    dist = ((x[:, None, :] - np.array(regimes.centres)[None]) ** 2).sum(2)
    assert (got["market_regime"] == dist.argmin(1)).all()
    assert regimes.inertia == pytest.approx(dist.min(1).sum())
    assert (got[[f"regime_{i}" for i in range(5)]].sum(axis=1) == 1).all()
    # each centre rests at the mean of its rows
    for i, c in enumerate(regimes.centres):
        assert np.allclose(x[(got["market_regime"] == i).to_numpy()].mean(0), c, atol=0.05)
    assert assign_regimes(test, regimes).filter("market_regime between 0 and 4").count() == test.count()
    summary = regime_summary(assign_regimes(train, regimes)).toPandas()
    assert summary["rows"].sum() == len(got) and summary["share_pct"].sum() == pytest.approx(100)


def test_elbow_falls(scaled):
    got = kmeans_elbow(scaled[0], ks=(2, 4, 8), inits=2).orderBy("k").toPandas()
    assert list(got["k"]) == [2, 4, 8] and got["inertia"].is_monotonic_decreasing


# --- calibration --------------------------------------------------------------
@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(6)
    predicted = rng.laplace(15, 120, 640)
    return spark.createDataFrame(pd.DataFrame({"predicted": predicted, "actual": 0.6 * predicted + rng.standard_t(4, 640) * 90}))


@pytest.mark.parametrize("c", [1e6, 1.0, 1e-3])
def test_calibration_is_the_penalised_optimum(pairs, c):
    cal = calibrate_fit(pairs, c=c)
    p = pairs.toPandas()
    x, y = p["predicted"].to_numpy(), (p["actual"] > 0).to_numpy(dtype=float)
    prob = 1 / (1 + np.exp(-(cal.coef * x + cal.intercept)))
    # gradient of sum(loss) + coef^2 / (2 c)
    assert abs((prob - y).sum()) < 1e-6 and abs(((prob - y) * x).sum() + cal.coef / c) < 1e-4
    assert cal.directional_accuracy == pytest.approx(((x > 0) == (y > 0)).mean())


def test_probabilities_rise_with_the_forecast(pairs):
    cal = calibrate_fit(pairs)
    got = calibrate_apply(pairs, cal).orderBy("predicted").toPandas()["probability"]
    assert got.is_monotonic_increasing and got.between(0, 1).all()


def test_unfitted_and_one_sided_calibration_raise(pairs):
    with pytest.raises(RuntimeError):
        calibrate_apply(pairs, Calibrator())
    with pytest.raises(ValueError):
        calibrate_fit(pairs.filter("actual > 0"))


def test_sigmoid_temperature(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1000, -10, 0, 10, 1000)], "predicted double")
    got = [r["probability"] for r in sigmoid_temperature(df).orderBy("predicted").collect()]
    assert got[2] == 0.5 and got[0] + got[4] == pytest.approx(1) and got == sorted(got)
    cold, warm = (sigmoid_temperature(df, temperature=t).orderBy("predicted").collect()[3]["probability"] for t in (1, 100))
    assert cold > warm > 0.5
    flat = spark.createDataFrame([(0.0,), (0.0,)], "predicted double")
    assert {r["probability"] for r in sigmoid_temperature(flat).collect()} == {0.5}


# --- metrics and histories ----------------------------------------------------
def test_metrics_and_constant_target(pairs, spark):
    p, got = pairs.toPandas(), error_metrics(pairs).first()
    e = p["predicted"] - p["actual"]
    assert got["mae"] == pytest.approx(e.abs().mean()) and got["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert got["r2"] == pytest.approx(1 - (e ** 2).sum() / ((p["actual"] - p["actual"].mean()) ** 2).sum())
    assert error_metrics(spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "actual double, predicted double")).first()["r2"] == 0


def replay(losses, patience, delta):
    best, best_epoch, waited = float("inf"), 0, 0
    for epoch, v in enumerate(losses, 1):
        if v < best - delta:
            best, best_epoch, waited = v, epoch, 0
        else:
            waited += 1
        if waited >= patience:
            return best_epoch, epoch, True
    return best_epoch, len(losses), False


def test_early_stopping_replay(spark):
    rng = np.random.default_rng(1)
    runs = {f"r{i}": (1 / np.arange(1, n + 1) + rng.normal(0, 0.05, n)).tolist() for i, n in enumerate((5, 30, 60, 130))}
    rows = [(r, e, v - 0.1, v) for r, vs in runs.items() for e, v in enumerate(vs, 1)]
    history = spark.createDataFrame(rows, "run_id string, epoch int, train_loss double, val_loss double").repartition(3)
    for row in early_stop_select(history, patience=6, min_delta=0.01).collect():
        want = replay(runs[row["run_id"]][:100], 6, 0.01)
        assert (row["best_epoch"], row["epochs_run"], row["stopped_early"]) == want
        assert row["gap_at_best"] == pytest.approx(0.1)
    assert {round(r["overfit_gap"], 9) for r in overfit_gap(history).collect()} == {0.1}
    for row in best_epoch(history).collect():
        assert row["best_epoch"] == int(np.argmin(runs[row["run_id"]])) + 1


def test_tiny_improvements_do_not_count(spark):
    rows = [("a", e, 0.0, 1.0 - e * 1e-6) for e in range(1, 15)]
    got = early_stop_select(spark.createDataFrame(rows, "run_id string, epoch int, train_loss double, val_loss double")).first()
    assert (got["best_epoch"], got["epochs_run"], got["stopped_early"]) == (1, 11, True)


# --- folds and ridge ----------------------------------------------------------
def test_fold_bounds_clip_month_ends(spark):
    df = spark.sql("select timestamp_ntz'2023-12-31 23:45:00' as date")
    got = [(str(r["val_start"])[:10], str(r["val_end"])[:10]) for r in fold_bounds(df).orderBy("fold_id").collect()]
    assert got == [("2021-12-30", "2022-06-30"), ("2022-06-30", "2022-12-30"), ("2022-12-30", "2023-06-30"), ("2023-06-30", "2023-12-31")]


def test_folds_expand_without_leakage(train):
    got = walk_forward_folds(train, days=1).toPandas()
    assert sorted(got["fold_id"].unique()) == [2, 3, 4] or sorted(got["fold_id"].unique()) == [1, 2, 3, 4]
    sizes, seen = [], set()
    for fold in sorted(got["fold_id"].unique()):
        part = got[got["fold_id"] == fold]
        tr, va = part[part["role"] == "train"], part[part["role"] == "val"]
        assert tr["date"].max() < va["date"].min() and len(tr) >= 96 and len(va) >= 96
        assert not seen & set(va["date"])
        seen |= set(va["date"])
        sizes.append(len(tr))
    assert sizes == sorted(sizes) and got["date"].max() == max(seen)


def brute_ridge(x, y, penalty):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + penalty * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return my - mx @ w, w


def test_walk_forward_cv_equals_refits(scaled):
    train, _, stats = scaled
    bounds = bounds_list(train, days=1)
    got = walk_forward_cv(train, bounds, CORE, stats=stats, penalty=2.0, length=20).orderBy("fold_id").toPandas()
    p = train.toPandas().sort_values("date").reset_index(drop=True)
    x, y = p[list(CORE)].to_numpy(), p["spread_scaled"].to_numpy()
    assert len(got) == 4
    for i, (_, start, end) in enumerate(bounds):
        tr = (p["date"] < start).to_numpy()
        va = np.flatnonzero(((p["date"] >= start) & ((p["date"] <= end) if i == 3 else (p["date"] < end))).to_numpy())
        a, w = brute_ridge(x[tr], y[tr], 2.0)
        at = va[19:]
        e = (a + x[at] @ w - y[at]) * stats["spread"][1]
        row = got.iloc[i]
        assert (row["train_rows"], row["val_rows"], row["scored_rows"]) == (tr.sum(), len(va), len(at))
        assert row["val_mae"] == pytest.approx(np.abs(e).mean()) and row["val_rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
        assert row["train_loss"] == pytest.approx(((a + x[tr] @ w - y[tr]) ** 2).mean())
        assert row["val_start"] == str(p["date"][va[0]])[:10]
    assert cv_summary(walk_forward_cv(train, bounds, CORE, stats=stats, length=20)).first()["folds"] == 4


def test_ridge_and_window_scoring(scaled, uneven):
    train, test, _ = scaled
    model = fit_ridge(train, CORE)
    assert isinstance(model, LinearModel)
    got = score_windows(test, CORE, model, length=10, keep=("ID",)).orderBy("ID").toPandas()
    x = test.orderBy("ID").toPandas()[list(CORE)].to_numpy(dtype=np.float32)
    assert got["predicted"][:9].isna().all()
    assert np.allclose(got["predicted"][9:], x[9:] @ np.array(model.weights) + model.intercept, atol=1e-5)
    spread = lambda w: w[:, :, 0].max(1) - w[:, 0, 0]
    layout = plan_layout(uneven, chunk_rows=200, **KW)
    same(score_windows(uneven, ("value",), spread, 30, layout=layout, **KW), score_windows(uneven, ("value",), spread, 30, **KW), ["id"])


def test_early_rows_take_the_first_prediction(test_table):
    rows = test_table.select("ID", "date")
    late = test_table.filter("ID >= 95").select("date", F.col("ID").cast("double").alias("predicted"))
    got = align_predictions(rows, late).orderBy("ID").toPandas()["predicted"]
    assert (got[:95] == 95).all() and (got[95:] == got.index[95:]).all()


# --- autoregression -------------------------------------------------------------
def series_frame(spark, y, name="a", start="2024-01-01"):
    pdf = pd.DataFrame({"date": pd.date_range(start, periods=len(y), freq="15min"), "wind": 0.0, "solar": 0.0, "load": 0.0, "spread": y})
    return spark.createDataFrame(pdf, TRAIN_SCHEMA).withColumn("series", F.lit(name))


def simulate(n, phi=(), theta=(), c=0.0, seed=0, x=None, beta=0.0):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(0, 1, n + 200), np.zeros(n + 200)
    for t in range(10, n + 200):
        y[t] = c + sum(p * y[t - 1 - i] for i, p in enumerate(phi)) + e[t] + sum(q * e[t - 1 - i] for i, q in enumerate(theta))
    return y[200:]


def test_ar_fit_is_least_squares_and_forecast_recurses(spark):
    y = simulate(800, (0.6, -0.3), c=1.0)
    df = series_frame(spark, y)
    model = arx_fit(df, ArxSpec(p=2))
    got = {r["term"]: r["value"] for r in model.coefficients().collect()}
    x = np.column_stack([np.ones(798), y[1:-1], y[:-2]])
    want = np.linalg.lstsq(x, y[2:], rcond=None)[0]
    assert [got["const"], got["ar_1"], got["ar_2"]] == pytest.approx(list(want))
    future = series_frame(spark, np.zeros(6), start="2024-02-01").drop("spread")
    ahead = arx_forecast(df, future, model).orderBy("date").toPandas()["predicted"]
    path = list(y)
    for _ in range(6):
        path.append(want[0] + want[1] * path[-1] + want[2] * path[-2])
    assert np.allclose(ahead, path[-6:])
    res = arx_residuals(df, model).orderBy("date").toPandas()
    assert np.allclose(res["residual"][2:], y[2:] - x @ want) and res["residual"][:2].isna().all()


def test_arma_fit_is_close_to_the_truth_for_each_series(spark):
    a, b = simulate(6000, (0.7,), (0.4,), seed=1), simulate(6000, (0.2,), (-0.5,), seed=2)
    df = series_frame(spark, a, "a").unionByName(series_frame(spark, b, "b"))
    kw = dict(series=("series",), order=("date",))
    model = arx_fit(df, ArxSpec(p=1, q=1), **kw)
    got = {(r["series"], r["term"]): r["value"] for r in model.coefficients().collect()}
    assert got[("a", "ar_1")] == pytest.approx(0.7, abs=0.05) and got[("a", "ma_1")] == pytest.approx(0.4, abs=0.06)
    assert got[("b", "ar_1")] == pytest.approx(0.2, abs=0.1) and got[("b", "ma_1")] == pytest.approx(-0.5, abs=0.1)
    layout = plan_layout(df, ("series",), ("date",), 500)
    same(arx_fit(df, ArxSpec(p=1, q=1), layout=layout, **kw).coefficients(), model.coefficients(), ["series", "term"], tol=1e-7)
    a = arx_forecast(df, df.limit(8).drop("spread"), model)
    b = arx_forecast(df, df.limit(8).drop("spread"), model, layout=layout)
    same(a, b, ["series", "date"], tol=1e-7)


def test_differenced_seasonal_forecast_continues_a_pattern(spark):
    t = np.arange(96 * 8)
    y = 10 + 0.01 * t + 5 * np.sin(2 * np.pi * t / 96)
    df = series_frame(spark, y)
    future = series_frame(spark, np.zeros(96), start="2024-01-09").drop("spread")
    model = arx_fit(df, ArxSpec(p=0, d=1, D=1, m=96, intercept=True))
    ahead = arx_forecast(df, future, model).orderBy("date").toPandas()["predicted"]
    t2 = np.arange(96 * 8, 96 * 9)
    assert np.allclose(ahead, 10 + 0.01 * t2 + 5 * np.sin(2 * np.pi * t2 / 96), atol=1e-6)


def test_exogenous_effect_with_dependent_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 500)
    df = series_frame(spark, 3 + 2 * x).toPandas().drop(columns="series").assign(wind=x, solar=2 * x)
    sdf = spark.createDataFrame(df, TRAIN_SCHEMA)
    model = arx_fit(sdf, ArxSpec(p=0, exog=("wind", "solar")))
    got = {r["term"]: r["value"] for r in model.coefficients().collect()}
    assert got["x_wind"] + 2 * got["x_solar"] == pytest.approx(2) and got["const"] == pytest.approx(3)


def brute_adf(y):
    dy, n = np.diff(y), len(y)
    top = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)

    def design(lags, skip):
        t = np.arange(skip, len(dy))
        return np.column_stack([np.ones(len(t)), y[t]] + [dy[t - k] for k in range(1, lags + 1)]), dy[t]

    def fit(x, z):
        b = np.linalg.lstsq(x, z, rcond=None)[0]
        return b, ((z - x @ b) ** 2).sum()

    aics = []
    for lags in range(top + 1):
        x, z = design(lags, top)
        ssr = fit(x, z)[1]
        aics.append(len(z) * (np.log(2 * np.pi * ssr / len(z)) + 1) + 2 * (2 + lags))
    lags = int(np.argmin(aics))
    x, z = design(lags, lags)
    b, ssr = fit(x, z)
    se = np.sqrt(ssr / (len(z) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return b[1] / se, lags, len(z)


def test_unit_root_test(spark):
    steady, walk = simulate(600, (0.5, 0.2), seed=3), np.cumsum(np.random.default_rng(4).normal(0, 1, 400))
    df = series_frame(spark, steady, "steady").unionByName(series_frame(spark, walk, "walk"))
    got = {r["series"]: r for r in adf_test(df, series=("series",)).collect()}
    for name, y, d in (("steady", steady, 0), ("walk", walk, 1)):
        stat, lags, nobs = brute_adf(y)
        assert got[name]["statistic"] == pytest.approx(stat, rel=1e-6)
        assert (got[name]["used_lag"], got[name]["nobs"], got[name]["d"]) == (lags, nobs, d)
    one = adf_test(series_frame(spark, steady)).first()
    assert one["statistic"] == pytest.approx(got["steady"]["statistic"], rel=1e-9)
    assert mackinnon_p(-2.8621) == pytest.approx(0.05, abs=0.001) and mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.001)


def test_small_systems_are_dealt_out_by_their_number(spark, monkeypatch):
    from slotcast.operators import autoreg, gram as gram_module

    rng = np.random.default_rng(5)
    rows = [(None if s == 7 else s, i, None if i == 11 else float("nan") if i == 17 else float(rng.normal(50, 9)), float(rng.normal(3, 1))) for s in range(40) for i in range(30)]
    df = spark.createDataFrame(rows, "s long, i long, y double, x double")
    wide = {(r["s"], r["i"], r["j"]): r["g"] for r in gram_module.gram(df, ["y", "x"], ["s"]).collect()}
    pairs = [(0, 0), (0, 1), (1, 1)]
    for most in (8, 0):
        monkeypatch.setattr(gram_module, "PLAIN_COLUMNS", most)
        got = gram_module.gram_arrays(df, ["y", "x"], ["s"]).collect()
        assert len(got) == 40
        for r in got:
            assert np.allclose(r["g"], [wide[r["s"], a, b] for a, b in pairs])
    clean = df.filter("not isnan(y)")
    plain = arx_fit(clean, ArxSpec(p=1, d=0, exog=("x",)), "y", ("s",), ("i",)).table.toPandas().sort_values("s", ignore_index=True)
    tasks, kept = [], autoreg.materialize
    monkeypatch.setattr(autoreg, "materialize", lambda t: tasks.append(t.rdd.getNumPartitions()) or kept(t))
    monkeypatch.setattr(autoreg, "TASK_SERIES", 4)
    dealt = arx_fit(clean, ArxSpec(p=1, d=0, exog=("x",)), "y", ("s",), ("i",)).table.toPandas().sort_values("s", ignore_index=True)
    assert tasks[:2] == [10, 10]
    assert len(dealt) == 40 and all(np.allclose(a, b) for a, b in zip(dealt["beta"], plain["beta"]))
