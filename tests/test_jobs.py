import numpy as np
import pytest
from conftest import market_frame
from pyspark.sql import functions as F

from slotcast import (
    Calibrator, best_epoch, bounds_list, classical_forecast, fit_ridge, forecast_prepared, load_calibrator, load_config,
    load_market, load_prepared, load_regimes, load_scaler, load_test, prepare, read_prepared, read_versioned, save_state, submission,
    walk_forward_cv, write_cv, write_history, write_prepared, write_submission,
)
from slotcast.schema import CORE, FEATURES, FeatureConfig, TEST_SCHEMA, TRAIN_SCHEMA


@pytest.fixture(scope="module")
def prepared(train, imbalances, test_table):
    return prepare(train, imbalances, test_table, inits=2)


def test_market_files_round_trip(spark, tmp_path, train_pd):
    pdf = train_pd.copy()
    pdf.loc[3, "wind"] = np.nan
    # column order differs from the schema on purpose
    pdf[["spread", "date", "load", "solar", "wind"]].to_csv(tmp_path / "train.csv", index=False)
    pdf[["date", "imbalances"]].to_csv(tmp_path / "imbalances.csv", index=False)
    pdf.assign(ID=range(len(pdf)))[["ID", "date", "wind", "solar", "load"]].to_csv(tmp_path / "test.csv", index=False)
    pdf.assign(ID=range(len(pdf)), forecast=0.5)[["ID", "forecast"]].to_csv(tmp_path / "sample.csv", index=False)
    tables = load_market(spark, str(tmp_path))
    got = tables["train"].orderBy("date").toPandas()
    assert tables["train"].schema == TRAIN_SCHEMA and tables["test"].schema == TEST_SCHEMA
    assert np.allclose(got["spread"], pdf["spread"]) and (got["date"] == pdf["date"]).all()
    assert tables["train"].filter("wind IS NULL").count() == 1
    assert {k: t.count() for k, t in tables.items()} == {k: len(pdf) for k in ("train", "imbalances", "test", "sample")}


def test_prepared_tables_have_the_documented_columns(prepared, train_pd):
    assert len(prepared.train.columns) == 64 and len(prepared.test.columns) == 55
    got = prepared.train.toPandas()
    assert len(got) == len(train_pd) and got.notna().all().all()
    assert set(FEATURES) <= set(prepared.train.columns) and set(FEATURES) <= set(prepared.test.columns)
    assert len(load_prepared(prepared.train).first()["features"]) == 45
    assert len(load_test(prepared.test).first()["features"]) == 45
    with pytest.raises(ValueError):
        load_test(prepared.test.drop("regime_0"))


def test_short_preparation(train, imbalances, test_table):
    p = prepare(train, imbalances, test_table, with_windows=False, inits=1)
    assert not [c for c in p.train.columns if "_lag_" in c] and "regime_4" in p.test.columns


def test_prepared_files_and_state(spark, tmp_path, prepared):
    write_prepared(prepared.train, f"{tmp_path}/train")
    back = read_prepared(spark, f"{tmp_path}/train")
    assert sorted(back.columns) == sorted(prepared.train.columns) and back.count() == prepared.train.count()
    write_prepared(prepared.test, f"{tmp_path}/test", kind="csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/test").count() == prepared.test.count()
    save_state(spark, f"{tmp_path}/state", prepared.scaler, prepared.regimes, Calibrator(0.1, 0.2, 0.6), FeatureConfig())
    assert load_scaler(spark, f"{tmp_path}/state").stats == prepared.scaler.stats
    assert load_regimes(spark, f"{tmp_path}/state") == prepared.regimes
    assert load_calibrator(spark, f"{tmp_path}/state") == Calibrator(0.1, 0.2, 0.6)
    assert load_config(spark, f"{tmp_path}/state") == FeatureConfig()


def test_metric_tables(spark, tmp_path, prepared):
    folds = walk_forward_cv(prepared.train, bounds_list(prepared.train, days=1), stats=prepared.scaler)
    write_cv(folds, f"{tmp_path}/cv")
    got = read_versioned(spark, f"{tmp_path}/cv")
    assert len(got.columns) == 12 and got.count() == folds.count() > 0
    history = spark.createDataFrame(
        [("a", i, 1.0 / i, 1.0 / i + 0.1, 0.001) for i in range(1, 6)],
        "run_id string, epoch int, train_loss double, val_loss double, learning_rate double")
    write_history(history, f"{tmp_path}/history")
    assert best_epoch(read_versioned(spark, f"{tmp_path}/history")).first()["best_epoch"] == 5


def test_submission_ids(spark, tmp_path, test_table):
    p = test_table.withColumn("probability", F.lit(0.25))
    grid_row = spark.createDataFrame([(None, None, None, None, None)], TEST_SCHEMA).withColumn("probability", F.lit(0.9))
    assert submission(p.union(grid_row)).count() == test_table.count()
    dense = submission(p.drop("ID")).orderBy("ID").toPandas()
    assert list(dense["ID"]) == list(range(test_table.count()))
    write_submission(p, f"{tmp_path}/sub")
    assert spark.read.option("header", True).csv(f"{tmp_path}/sub").columns == ["ID", "forecast"]


def test_forecast_from_prepared(prepared, test_table):
    f = forecast_prepared(prepared, features=CORE, length=24)
    got = f.submission.orderBy("ID").toPandas()
    assert list(got["ID"]) == list(range(test_table.count())) and got["forecast"].between(0, 1).all()
    assert (got["forecast"][:24] == got["forecast"][23]).all()
    assert f.metrics.first()["n"] == prepared.train.count() - int(prepared.train.count() * 0.8) - 23



def test_any_predictor_can_be_scored(prepared):
    model = fit_ridge(prepared.train, CORE)
    f = forecast_prepared(prepared, features=CORE, length=24, predictor=lambda w: model(w))
    assert f.submission.count() == prepared.test.count()


@pytest.mark.parametrize("family", ["arima", "arimax", "sarima"])
def test_classical_families(spark, family):
    pdf = market_frame(9, "2023-03-01", 11)
    rng = np.random.default_rng(0)
    y = np.zeros(len(pdf))
    for t in range(1, len(pdf)):
        y[t] = 0.6 * y[t - 1] + rng.normal(0, 50)
    pdf["spread"] = y
    train = spark.createDataFrame(pdf[["date", "wind", "solar", "load", "spread"]], TRAIN_SCHEMA)
    test = market_frame(1, "2023-03-10", 12)
    test.insert(0, "ID", range(len(test)))
    test = spark.createDataFrame(test[["ID", "date", "wind", "solar", "load"]], TEST_SCHEMA).filter("ID <> 7")
    sub, run = classical_forecast(train, test, family, holdout=96, fit_rows=600)
    got = sub.orderBy("ID").toPandas()
    assert len(got) == 95 and got["forecast"].between(0, 1).all()
    row = run.metrics.first()
    assert row["n"] == 96 and 0 <= row["directional_accuracy"] <= 1 and np.isfinite(row["rmse"])
    assert run.d == 0
