"""Cases in which an operator once gave wrong rows: zones, offsets, differenced regressors, thin folds, holes, short series."""

import os
import subprocess
import sys
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotcast.operators.autoreg import ArxSpec, arx_fit, arx_forecast
from slotcast.operators.folds import bounds_list, walk_forward_folds
from slotcast.operators.linear import align_predictions, fit_ridge, walk_forward_cv
from slotcast.operators.regimes import fit_regimes

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
IN_ZONE = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from slotcast.operators.folds import bounds_list, fold_sizes
from slotcast.operators.slices import first_rows, last_rows
from slotcast.session import local_session
spark = local_session(2, "zone")
df = spark.range(2000).select(F.expr("timestamp_ntz'2023-03-01 00:00:00' + make_dt_interval(0, 0, 15 * id)").alias("date"), "id")
for n in (0, 10**9):
    print("ROWS", [sorted(r["id"] for r in f(df, 50, sortable=n).collect()) == want for f, want in ((first_rows, list(range(50))), (last_rows, list(range(1950, 2000))))])
print("FOLDS", fold_sizes(df, bounds_list(df, folds=3, days=3)))
"""


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_naive_times_do_not_move_with_the_process_zone(zone):
    out = subprocess.run([sys.executable, "-c", IN_ZONE.format(root=ROOT)], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=300).stdout
    assert out.count("ROWS [True, True]") == 2 and "FOLDS {1: (1135, 288), 2: (1423, 288), 3: (1711, 289)}" in out, out


def panel(spark, series: dict):
    rows = [(s, datetime(2023, 1, 1) + timedelta(minutes=15 * i), *map(float, np.atleast_1d(v))) for s, values in series.items() for i, v in enumerate(values)]
    extra = ", wind double" if len(rows[0]) > 3 else ""
    return spark.createDataFrame(rows, f"series string, date timestamp_ntz, value double{extra}")


def test_slopes_do_not_depend_on_the_level(spark):
    rng = np.random.default_rng(1)
    y = np.zeros(800)
    for i in range(1, 800):
        y[i] = 0.8 * y[i - 1] + rng.normal()
    df = panel(spark, {str(k): y + 10.0**k for k in (0, 4, 7, 9)})
    got = {r["series"]: r["value"] for r in arx_fit(df, ArxSpec(p=1), "value", ("series",)).coefficients().filter("term = 'ar_1'").collect()}
    assert all(abs(v - got["0"]) < 1e-3 for v in got.values())
    x = rng.normal(size=800)
    frame = spark.createDataFrame([(float(a + 1e7), float(2 * a + 1e7 + b)) for a, b in zip(x, rng.normal(0, 0.01, 800))], "x double, y double")
    model = fit_ridge(frame, ("x",), "y", 0.0)
    assert abs(model.weights[0] - 2) < 1e-3


def test_regressors_are_differenced_with_the_target(spark):
    rng = np.random.default_rng(2)
    x, walk = np.zeros(1500), np.cumsum(rng.normal(size=1500))
    for i in range(1, 1500):
        x[i] = 0.95 * x[i - 1] + rng.normal(0, 3)
    df = panel(spark, {"a": np.column_stack([3 * x + walk, x])})
    past, ahead = df.filter(F.col("date") < datetime(2023, 1, 15)), df.filter(F.col("date") >= datetime(2023, 1, 15))
    assert past.count() == 1344
    for spec in (ArxSpec(p=0, d=1, exog=("wind",)), ArxSpec(p=1, d=1, q=1, exog=("wind",))):
        model = arx_fit(past, spec, "value", ("series",))
        beta = {r["term"]: r["value"] for r in model.coefficients().collect()}
        assert abs(beta["x_wind"] - 3) < 0.05
        out = arx_forecast(past, ahead.withColumn("actual", F.col("value")), model).toPandas()
        flat = np.abs(ahead.toPandas()["value"] - 3 * x[1344:] - walk[1343]).mean()
        assert (out["predicted"] - out["actual"]).abs().mean() < 1.5 * flat + 1


def test_short_series_get_null_and_others_a_forecast(spark):
    rng = np.random.default_rng(3)
    df = panel(spark, {"long": rng.normal(size=300), "three": [1, 2, 3], "one": [1]})
    future = panel(spark, {s: [0, 0] for s in ("long", "three", "one")}).withColumn("date", F.expr("date + INTERVAL 30 DAYS"))
    for spec in (ArxSpec(p=2), ArxSpec(p=2, q=2), ArxSpec(p=1, d=1, q=0)):
        got = arx_forecast(df, future, arx_fit(df, spec, "value", ("series",))).toPandas().groupby("series")["predicted"].count()
        assert got["long"] == 2 and got["one"] == 0


def test_predictions_fill_only_leading_rows(spark):
    day = datetime(2023, 1, 1)
    rows = spark.createDataFrame([(s, day + timedelta(hours=i)) for s in "ab" for i in range(6)], "series string, date timestamp_ntz")
    made = spark.createDataFrame([("a", day + timedelta(hours=i), float(i)) for i in (2, 3, 5)] + [("b", day + timedelta(hours=4), 9.0)], "series string, date timestamp_ntz, predicted double")
    got = align_predictions(rows, made, keys=("series", "date"), series=("series",)).orderBy("series", "date").toPandas()["predicted"].tolist()
    assert [None if np.isnan(v) else v for v in got] == [2, 2, 2, 3, None, 5, 9, 9, 9, 9, 9, None]
    one = align_predictions(rows.filter("series = 'a'"), made.filter("series = 'a'").drop("series")).orderBy("date").toPandas()["predicted"].tolist()
    assert [None if np.isnan(v) else v for v in one] == [2, 2, 2, 3, None, 5]


@pytest.mark.parametrize("gap", [(480, 960), (960, 1440), (1440, 1920)])
def test_folds_with_a_thin_one_among_them(spark, gap):
    rng = np.random.default_rng(4)
    keep = [i for i in range(1921) if not gap[0] <= i < gap[1] - 30]
    df = spark.createDataFrame([(datetime(2023, 1, 1) + timedelta(minutes=15 * i), float(rng.normal()), float(rng.normal())) for i in keep], "date timestamp_ntz, x double, y double")
    bounds = bounds_list(df, folds=3, days=5)
    got = [(r["val_rows"], r["train_rows"]) for r in walk_forward_cv(df, bounds, ("x",), "y").orderBy("fold_id").collect()]
    sizes = walk_forward_folds(df, folds=3, days=5).groupBy("fold_id").pivot("role", ["val", "train"]).count().orderBy("fold_id").collect()
    assert got == [(r["val"], r["train"]) for r in sizes] and len(got) == 2


def test_regimes_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 1, (4000, 2)) for c in (0, 8, 16, 30)])
    df = spark.createDataFrame(pd.DataFrame(points, columns=["a", "b"]))
    few, many = (fit_regimes(df.repartition(n), ("a", "b"), k=4, inits=3) for n in (3, 7))
    assert np.allclose(few.centres, many.centres) and few.inertia == pytest.approx(many.inertia)
    assert np.allclose(sorted(c[0] for c in few.centres), [0, 8, 16, 30], atol=0.2)
