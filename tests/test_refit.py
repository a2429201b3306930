"""Models refitted for every fold, against one NumPy loop per fold."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from slotcast import Huber, SignLogit, bounds_list, refit_per_fold, walk_forward_cv
from slotcast.operators.linear import FOLD_SCHEMA

COLS = ("wind", "solar", "load")


def slow_huber(x, y, delta, penalty):
    a = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(a.shape[1])
    for _ in range(500):
        w = np.minimum(1, delta / np.maximum(np.abs(y - a @ beta), 1e-300))
        new = np.linalg.solve((a * w[:, None]).T @ a + penalty * np.diag([0.0, 1, 1, 1]), (a * w[:, None]).T @ y)
        if np.abs(new - beta).max() < 1e-12:
            break
        beta = new
    return beta


def slow_logit(x, y, penalty):
    a = np.column_stack((np.ones(len(x)), x))
    beta, ridge = np.zeros(a.shape[1]), penalty * np.diag([0.0, 1, 1, 1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ beta))
        move = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ ((y > 0) - p) - ridge @ beta)
        beta = beta + move
    return beta


@pytest.fixture(scope="module")
def rows(train):
    # a hole in a feature and in the target
    at = F.row_number().over(Window.orderBy("date"))
    df = train.withColumns({"wind": F.col("wind") / 1000, "solar": F.col("solar") / 1000, "load": F.col("load") / 10_000, "y": F.col("spread") / 100, "at": at})
    return df.withColumn("wind", F.when(F.col("at") != 7, F.col("wind"))).withColumn("y", F.when(F.col("at") != 9, F.col("y"))).drop("at").persist()


@pytest.mark.parametrize("model", [Huber(delta=0.3), Huber(delta=0.8, penalty=2.0), SignLogit(penalty=0.5)])
def test_every_fold_is_fitted_anew(rows, model):
    bounds = bounds_list(rows, days=1)
    got = refit_per_fold(rows, bounds, COLS, "y", model, length=10).orderBy("fold_id").toPandas()
    p = rows.toPandas().sort_values("date").reset_index(drop=True)
    x, y = p[list(COLS)].to_numpy(float), p["y"].to_numpy(float)
    whole = np.isfinite(x).all(axis=1) & np.isfinite(y)
    mean = np.nanmean(x, axis=0)
    assert len(got) == 4 and (got["iterations"] > 1).all()
    for i, (_, start, end) in enumerate(bounds):
        tr = (p["date"] < start).to_numpy() & whole
        va = np.flatnonzero(((p["date"] >= start) & ((p["date"] <= end) if i == 3 else (p["date"] < end))).to_numpy())
        if isinstance(model, Huber):
            beta = slow_huber(x[tr] - mean, y[tr], model.delta, model.penalty)
            predict = lambda z: beta[0] + (z - mean) @ beta[1:]
        else:
            beta = slow_logit(x[tr] - mean, y[tr], model.penalty)
            predict = lambda z: 1 / (1 + np.exp(-beta[0] - (z - mean) @ beta[1:])) - 0.5
        row = got.iloc[i]
        assert row["train_loss"] == pytest.approx(((y[tr] - predict(x[tr])) ** 2).mean(), rel=1e-6)
        e = predict(x[va[9:]]) - y[va[9:]]
        assert row["val_mae"] == pytest.approx(np.nanmean(np.abs(e)), rel=1e-6)
        assert (row["train_rows"], row["val_rows"]) == ((p["date"] < start).sum(), len(va))


def test_far_delta_is_least_squares(rows):
    bounds = bounds_list(rows, days=1)
    whole = rows.filter("wind is not null and y is not null")
    a = refit_per_fold(whole, bounds, COLS, "y", Huber(delta=1e9), length=10).drop("iterations").orderBy("fold_id").toPandas()
    b = walk_forward_cv(whole, bounds, COLS, "y", penalty=0.0, length=10).orderBy("fold_id").toPandas()
    for c in a.columns:
        assert np.allclose(a[c], b[c]) if a[c].dtype.kind == "f" else (a[c] == b[c]).all()


def test_no_usable_fold(rows):
    none = refit_per_fold(rows, bounds_list(rows, days=1), COLS, "y", length=10_000)
    assert none.count() == 0 and none.drop("iterations").schema.simpleString() == rows.sparkSession.createDataFrame([], FOLD_SCHEMA).schema.simpleString()
