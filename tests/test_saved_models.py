import json

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slotcast import (
    ArxSpec, LinearModel, arx_fit, arx_forecast, css_fit, css_forecast, load_model, median_fill, save_model, write_versioned,
)

KW = dict(series=("series",), order=("ts",))


@pytest.fixture(scope="module")
def frame(spark):
    rng, rows = np.random.default_rng(2), []
    for name, n in (("a", 200), ("b", 90), (None, 70)):
        y = np.cumsum(rng.normal(0, 1, n)) * 0.2 + rng.normal(0, 1, n)
        rows += [(name, t, float(v), float(rng.normal())) for t, v in zip(pd.date_range("2024-01-01", periods=n, freq="h").to_pydatetime(), y)]
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double, x double").repartition(3).persist()


@pytest.mark.parametrize("fit,forecast", [(arx_fit, arx_forecast), (css_fit, css_forecast)])
def test_a_loaded_model_forecasts_the_same(spark, tmp_path, frame, fit, forecast):
    spec = ArxSpec(p=2, q=1, exog=("x",))
    model = fit(frame, spec, "y", **KW)
    save_model(spark, model, f"{tmp_path}/m")
    loaded = load_model(spark, f"{tmp_path}/m/")
    assert type(loaded) is type(model) and loaded.spec == spec and (loaded.series, loaded.order, loaded.target, loaded.count) == (("series",), ("ts",), "y", model.count)
    future = frame.filter("series is not null").groupBy("series").agg(F.max("ts").alias("ts")).select(
        "series", (F.col("ts") + F.expr("interval 1 hour")).alias("ts"), F.lit(0.5).alias("x"))
    a, b = (forecast(frame, future, m).orderBy("series").toPandas() for m in (model, loaded))
    pd.testing.assert_frame_equal(a, b)


def test_ridge_comes_back_as_it_was(spark, tmp_path):
    model = LinearModel(("wind", "solar"), (0.1 + 0.2, -1e-17), 3.25)
    save_model(spark, model, f"{tmp_path}/r")
    assert load_model(spark, f"{tmp_path}/r") == model
    save_model(spark, LinearModel((), (), 1.0), f"{tmp_path}/r")
    assert load_model(spark, f"{tmp_path}/r") == LinearModel((), (), 1.0)


def test_a_failed_save_leaves_the_model_before(spark, tmp_path, frame):
    path = f"{tmp_path}/m"
    model = arx_fit(frame, ArxSpec(p=1), "y", **KW)
    first = save_model(spark, model, path)
    broken = arx_fit(frame, ArxSpec(p=2), "y", **KW)
    broken.table = broken.table.withColumn("nobs", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(PySparkException):
        save_model(spark, broken, path)
    assert load_model(spark, path).spec == ArxSpec(p=1)
    # coefficients of a save that stopped before its description aren't taken for the model's
    write_versioned(model.table.limit(0), f"{path}/fits")
    assert load_model(spark, path).count == 3
    save_model(spark, arx_fit(frame, ArxSpec(p=3), "y", **KW), path)
    assert load_model(spark, path).spec.p == 3 and load_model(spark, path, first).spec.p == 1
    assert json.loads(json.dumps(load_model(spark, path).series)) == ["series"]


@pytest.mark.parametrize("small", [10, 1_000_000])
def test_each_series_is_filled_with_its_own_median(spark, small):
    rows = [("a", i, None if i % 5 == 0 else float(i)) for i in range(60)] + [("b", i, 7.0 if i else None) for i in range(30)]
    rows += [("empty", 0, None), (None, 0, None), (None, 1, 2.0), (None, 2, 4.0)]
    df = spark.createDataFrame(rows, "series string, i int, v double")
    got = {(r["series"], r["i"]): r["v"] for r in median_fill(df, "v", series=("series",), small=small).collect()}
    assert len(got) == len(rows)
    medians = {"a": float(np.median([i for i in range(60) if i % 5])), "b": 7.0, "empty": None, None: 3.0}
    assert all(got[s, i] == (medians[s] if v is None else v) for s, i, v in rows)
    by = df.withColumn("v", F.col("v") * 10)
    assert {r["v"] for r in median_fill(df, "v", by=by, series=("series",)).filter("series = 'a' and i % 5 = 0").collect()} == {medians["a"] * 10}
    assert median_fill(df.limit(0), "v", series=("series",)).columns == df.columns
