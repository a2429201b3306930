import numpy as np
import pandas as pd
import pytest
from test_models import brute_adf

from slotcast import adf_test
from slotcast.operators.unitroot import cross_products, mackinnon_p, unit_root


def series_frame(spark, named):
    """Values of several series, in no order."""
    frames = [pd.DataFrame({"series": k, "ts": pd.date_range("2024-01-01", periods=len(y), freq="15min"), "value": y}) for k, y in named.items()]
    return spark.createDataFrame(pd.concat(frames).sample(frac=1, random_state=1), "series string, ts timestamp_ntz, value double").repartition(4)


def autoregression(n, weights, seed):
    rng, y = np.random.default_rng(seed), np.zeros(n + 200)
    for t in range(len(weights), len(y)):
        y[t] = sum(w * y[t - 1 - i] for i, w in enumerate(weights)) + rng.normal()
    return y[200:]


KW = dict(column="value", series=("series",), order=("ts",))


def samples():
    out = {f"steady{i}": autoregression(300 + 37 * i, (0.5, 0.2, -0.3), i) + 40000 for i in range(4)}
    out |= {f"walk{i}": np.cumsum(np.random.default_rng(90 + i).normal(0, 3, 120 + 211 * i)) for i in range(4)}
    return out | {"season": autoregression(900, (0.3,) + (0.0,) * 10 + (0.5,), 5), "tiny": np.array([3.0, 1, 4, 1, 5, 9, 2, 6])}


@pytest.mark.parametrize("chunk_rows", [None, 100])
def test_equal_to_refitting_every_lag_count(spark, chunk_rows):
    named = samples()
    got = {r["series"]: r for r in adf_test(series_frame(spark, named), chunk_rows=chunk_rows, **KW).collect()}
    assert set(got) == set(named)
    for name, y in named.items():
        stat, lags, nobs = brute_adf(y - y.mean())  # products of columns far from zero would cost it digits
        r = got[name]
        assert (r["used_lag"], r["nobs"]) == (lags, nobs), name
        assert r["statistic"] == pytest.approx(stat, rel=1e-6), name
        assert r["p_value"] == pytest.approx(mackinnon_p(stat), rel=1e-5) and r["d"] == int(not r["p_value"] < 0.05)


def test_one_series_without_a_key(spark):
    y = samples()["steady1"]
    df = series_frame(spark, {"a": y}).drop("series")
    for chunk_rows in (None, 64):
        (r,) = adf_test(df, "value", order=("ts",), chunk_rows=chunk_rows).collect()
        stat, lags, nobs = brute_adf(y - y.mean())
        assert (r["used_lag"], r["nobs"], r["d"]) == (lags, nobs, 0) and r["statistic"] == pytest.approx(stat, rel=1e-6)
    (r,) = adf_test(df, "value", max_rows=150, order=("ts",)).collect()
    assert r["statistic"] == pytest.approx(brute_adf(y[:150] - y[:150].mean())[0], rel=1e-6)


def test_missing_values_are_left_out_and_short_or_constant_series_have_no_statistic(spark):
    y = samples()["steady2"]
    holes = y.copy()
    holes[::5] = np.nan
    named = {"holes": holes, "flat": np.full(50, 7.0), "short": np.arange(7.0), "none": np.full(20, np.nan)}
    for chunk_rows in (None, 30):
        got = {r["series"]: r for r in adf_test(series_frame(spark, named), chunk_rows=chunk_rows, **KW).collect()}
        assert got["holes"]["statistic"] == pytest.approx(brute_adf(y[~np.isnan(holes)] - 40000)[0], rel=1e-6)
        assert set(got) == {"holes", "flat", "short"}
        for name in ("flat", "short"):
            assert got[name]["statistic"] is None and got[name]["p_value"] is None and got[name]["d"] == 1
    assert adf_test(series_frame(spark, {"short": np.arange(3.0)}).limit(0), **KW).count() == 0


def test_dependent_columns_share_their_effect():
    """A period of two makes the lagged steps multiples of each other."""
    y = np.tile([1.0, 3.0], 60) + np.random.default_rng(1).normal(0, 1e-12, 120)
    stat, lags, nobs = unit_root(cross_products(y, y.mean(), 5, 6), y[:6], y.mean())
    assert lags <= 5 and nobs == 119 - lags and (np.isnan(stat) or stat < 0)


def test_p_values_at_known_points():
    assert mackinnon_p(-2.8621) == pytest.approx(0.05, abs=0.001) and mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.001)


def test_rows_are_shuffled_once_into_blocks(spark):
    """The result's plan starts from the stored blocks: no window is left in it."""
    plan = adf_test(series_frame(spark, samples()), chunk_rows=100, **KW)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "mapInArrow" in plan.replace("MapInArrow", "mapInArrow")
