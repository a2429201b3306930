"""Forecast jobs: from prepared tables, or from raw series with classical models, to submissions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import arimax_exog, fourier_arimax, fourier_sarima, sarima_exog
from ..operators.autoreg import ArxModel, ArxSpec, arx_fit, arx_forecast
from ..operators.css import BLOCK_ROWS, CssModel, css_fit, css_forecast
from ..operators.calibrate import FREE, SCRIPT_C, Calibrator, calibrate_apply, calibrate_fit
from ..operators.evaluate import directional_accuracy, error_metrics
from ..operators.grid import median_fill, regular_grid
from ..operators.linear import LinearModel, align_predictions, fit_ridge, score_windows
from ..operators.scaling import exog_stats, inverse_scale, standardize_exog
from ..operators.timeline import plan_layout
from ..operators.slices import holdout_tail, last_rows, temporal_split
from ..operators.unitroot import adf_test
from ..schema import (
    ADF_ROWS, ARIMA_HOLDOUT_ROWS, ARIMA_TRAIN_ROWS, FEATURES, SEQUENCE_LENGTH, TARGET, VALIDATION_FRACTION, present,
)
from ..session import materialize
from ..sources.sinks import submission
from .prepare import Prepared


@dataclass
class Forecast:
    submission: DataFrame
    validation: DataFrame          # date, actual, predicted
    metrics: DataFrame
    calibrator: Calibrator


def forecast_prepared(p: Prepared, fraction: float = VALIDATION_FRACTION, features=FEATURES, predictor=None,
                      length: int = SEQUENCE_LENGTH, c: float = FREE) -> Forecast:
    """Fit on the first part of train, calibrate on the rest, score the test table.

    ``predictor`` may be any picklable callable on windows (m, length, features);
    by default a ridge model on the window's last row is fitted here. Predictions
    return to the target's unit before calibration; test rows too early for a
    full window take the first prediction.
    """
    cols = present(p.train, features)
    split = temporal_split(p.train, fraction)
    predictor = predictor or fit_ridge(split.filter("role = 'train'"), cols)
    val = score_windows(split.filter("role = 'val'"), cols, predictor, length, keep=(TARGET,))
    val = inverse_scale(val.filter("predicted IS NOT NULL"), p.scaler, "predicted").withColumnRenamed(TARGET, "actual")
    calibrator = calibrate_fit(val, c=c)
    scored = inverse_scale(score_windows(p.test, cols, predictor, length, keep=("ID",)), p.scaler, "predicted")
    placed = align_predictions(p.test.select("ID", "date"), scored.select("date", "predicted"))
    return Forecast(submission(calibrate_apply(placed, calibrator)), val, error_metrics(val), calibrator)


@dataclass
class Classical:
    model: ArxModel | CssModel
    validation: DataFrame
    metrics: DataFrame
    calibrator: Calibrator
    d: int


def holdout_eval(y: DataFrame, spec: ArxSpec, target: str = TARGET, holdout: int = ARIMA_HOLDOUT_ROWS,
                 fit_rows: int | None = None, series=(), order=("date",), method: str = "regression") -> tuple[DataFrame, DataFrame]:
    """Fit on the rows before the holdout, forecast it, and measure: (validation rows, metrics).

    ``method`` is ``regression`` (two steps, product lags free) or ``css`` (least sum of squared shocks).
    """
    layout = plan_layout(y, series, order)
    # the fit, the forecast and the metrics all read these rows
    roles = materialize(holdout_tail(y, holdout, fit_rows, series, order, layout=layout))
    layout = layout.for_subset()
    fit = roles.filter("role = 'fit'").drop("role")
    val = roles.filter("role = 'val'").drop("role")
    if method == "css" and layout is not None and layout.longest > BLOCK_ROWS:
        layout = None
    fitted, ahead = (css_fit, css_forecast) if method == "css" else (arx_fit, arx_forecast)
    model = fitted(fit, spec, target, series, order, layout=layout)
    predicted = ahead(fit, val.withColumnRenamed(target, "actual"), model, layout=layout)
    # read by the metrics and, pass after pass, by the calibration
    rows = materialize(predicted.select(*series, *order, "actual", "predicted"))
    metrics = error_metrics(rows, by=tuple(series))
    hits = directional_accuracy(rows, by=tuple(series))
    if series:
        metrics = metrics.join(hits, list(series))
    else:
        metrics = metrics.withColumn("directional_accuracy", F.lit(hits.first()[0]))
    return rows, metrics


# --- fixed values: orders of the three model families -------------------------
ARIMA = ArxSpec(p=2, q=2)
ARIMAX = ArxSpec(p=2, q=2, exog=tuple(arimax_exog()), intercept=False)
SARIMA = ArxSpec(p=1, q=1, P=1, D=1, Q=1, m=96, exog=tuple(sarima_exog()), intercept=False)


def classical_forecast(train: DataFrame, test: DataFrame, family: str = "arima", holdout: int = ARIMA_HOLDOUT_ROWS,
                       fit_rows: int = ARIMA_TRAIN_ROWS) -> tuple[DataFrame, Classical]:
    """Raw tables to submission with one of the families ``arima``, ``arimax``, ``sarima``.

    Grid, median fill, unit-root test for d, regressors standardised on train,
    holdout evaluation and calibration, final fit on the last year (``fit_rows``), forecast of
    every test slot. Parameters of all parts are found jointly, by conditional sum of squares.
    """
    # every later step starts from these two tables
    y, ahead = materialize(regular_grid(train)), materialize(regular_grid(test))
    y = median_fill(y, TARGET)
    d = adf_test(y, max_rows=ADF_ROWS).first()["d"]
    spec = {"arima": ARIMA, "arimax": ARIMAX, "sarima": SARIMA}[family]
    if family != "arima":
        add = fourier_arimax if family == "arimax" else fourier_sarima
        y, ahead = add(y), add(ahead)
        stats = exog_stats(y, spec.exog)
        guard = family == "arimax"
        y, ahead = (standardize_exog(f, stats, spec.exog, guard) for f in (y, ahead))
    spec = ArxSpec(**{**spec.__dict__, "d": d, "intercept": family == "arima" and d == 0})
    y = y.select("date", TARGET, *spec.exog)
    if spec.exog:
        y = materialize(y)  # regressors are read by the holdout and by both fits
    validation, metrics = holdout_eval(y, spec, holdout=holdout, fit_rows=fit_rows, method="css")
    calibrator = calibrate_fit(validation, c=SCRIPT_C)
    last_year = last_rows(y, fit_rows)
    model = css_fit(last_year, spec)
    forecast = calibrate_apply(css_forecast(last_year, ahead, model), calibrator)
    return submission(forecast), Classical(model, validation, metrics, calibrator, d)
