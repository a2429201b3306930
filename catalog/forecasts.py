"""Autoregressive models, walk-forward validation, windowed scoring and whole jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from slotcast.operators.autoreg import ArxSpec, arx_fit, arx_forecast, arx_residuals
from slotcast.operators.css import CssModel, css_fit, css_forecast, css_residuals
from slotcast.operators.folds import bounds_list
from slotcast.operators.linear import align_predictions, score_windows, walk_forward_cv
from slotcast.operators.scaling import fit_scaler, scale_train
from slotcast.operators.refit import Huber, refit_per_fold
from slotcast.operators.slices import holdout_tail
from slotcast.operators.unitroot import adf_test
from slotcast.plans.forecast import classical_forecast, forecast_prepared, holdout_eval
from slotcast.plans.prepare import prepare
from slotcast.schema import FEATURES
from slotcast.session import materialize
from slotcast.sources.sampletables import (
    PANEL_ORDER, event_series, market_imbalances, market_test, market_train, panel,
)

from . import ORACLES, q, register
from .samples import EVENTS, MARKET, PANEL, TEST, TRAIN
from .windows import BOUNDS_DAYS, EW, PKEYS, PW

AR1 = ArxSpec(p=1)
PSERIES = dict(series=("series",), order=PANEL_ORDER)
ESERIES = dict(series=("series",), order=("ts", "event_id"))
AR1_FIT = "fit AS (SELECT series, regr_slope(value, l) AS phi, regr_intercept(value, l) AS c FROM {t} GROUP BY 1)"


@register("adf_test")
def _(spark, sf):
    return adf_test(market_train(spark, sf))


@register("adf_test_series")
def _(spark, sf):
    return adf_test(event_series(spark, sf), "value", **ESERIES)


@register("arx_fit", f"""WITH {PANEL}, l AS (SELECT series, value, lag(value) OVER {PW}) AS l FROM panel), {AR1_FIT.format(t='l')}
SELECT series, 'const' AS term, {q('c', 'value', 3)} FROM fit UNION ALL SELECT series, 'ar_1', {q('phi', 'value', 3)} FROM fit""", digits=3)
def _(spark, sf):
    return arx_fit(panel(spark, sf), AR1, "value", **PSERIES).coefficients()


@register("arx_fit_exog", f"""WITH {PANEL}, l AS (SELECT series, value - lag(value) OVER {PW}) AS dy, (quantity - lag(quantity) OVER {PW}))::DOUBLE AS x FROM panel)
SELECT series, 'const' AS term, {q('regr_intercept(dy, x)', 'value', 3)} FROM l GROUP BY 1
UNION ALL SELECT series, 'x_quantity', {q('regr_slope(dy, x)', 'value', 3)} FROM l GROUP BY 1""", digits=3)
def _(spark, sf):
    spec = ArxSpec(p=0, d=1, exog=("quantity",))
    return arx_fit(panel(spark, sf), spec, "value", **PSERIES).coefficients()


@register("arx_fit_offset", f"""WITH {PANEL}, l AS (SELECT series, value, lag(value) OVER {PW}) AS l FROM panel), {AR1_FIT.format(t='l')}
SELECT series, 'ar_1' AS term, {q('phi', 'value', 3)} FROM fit""", digits=3)
def _(spark, sf):
    far = panel(spark, sf).withColumn("value", F.col("value") + 1e8)  # slopes don't depend on the level
    return arx_fit(far, AR1, "value", **PSERIES).coefficients().filter("term = 'ar_1'")


@register("arx_forecast_exog", f"""WITH {PANEL}, i AS MATERIALIZED (SELECT *, row_number() OVER {PW}) AS pos, count(*) OVER (PARTITION BY series) AS n FROM panel),
d AS (SELECT series, value - lag(value) OVER (PARTITION BY series ORDER BY pos) AS dy, (quantity - lag(quantity) OVER (PARTITION BY series ORDER BY pos))::DOUBLE AS dx FROM i WHERE n - pos >= 24),
fit AS MATERIALIZED (SELECT series, regr_slope(dy, dx) AS b, regr_intercept(dy, dx) AS c FROM d GROUP BY 1),
last AS MATERIALIZED (SELECT series, value AS y, quantity AS x FROM i WHERE n - pos = 24),
tail AS MATERIALIZED (SELECT * FROM i WHERE n - pos < 24)
SELECT tail.series, {q('tail.value', 'actual', 2)}, tail.l_orderkey, tail.l_linenumber, tail.l_partkey, {q('y + b * (tail.quantity - x) + c * (24 - (n - pos))', 'predicted', 2)}
FROM tail JOIN fit ON tail.series = fit.series JOIN last ON tail.series = last.series""", digits=2)
def _(spark, sf):
    roles = materialize(holdout_tail(panel(spark, sf), 24, None, **PSERIES))  # many jobs read both parts
    past, ahead = (roles.filter(F.col("role") == r).drop("role") for r in ("fit", "val"))
    spec = ArxSpec(p=0, d=1, exog=("quantity",))
    out = arx_forecast(past, ahead.withColumn("actual", F.col("value")), arx_fit(past, spec, "value", **PSERIES))
    return out.select("series", "actual", "l_orderkey", "l_linenumber", "l_partkey", "predicted")


@register("arx_fit_long", f"""WITH {EVENTS}, l AS (SELECT series, value, lag(value) OVER {EW}) AS l FROM es), {AR1_FIT.format(t='l')}
SELECT series, 'const' AS term, {q('c', 'value', 4)} FROM fit UNION ALL SELECT series, 'ar_1', {q('phi', 'value', 4)} FROM fit""")
def _(spark, sf):
    return arx_fit(event_series(spark, sf), AR1, "value", chunk_rows=512, **ESERIES).coefficients()


@register("arma_fit", digits=3)
def _(spark, sf):
    return arx_fit(event_series(spark, sf), ArxSpec(p=2, q=2), "value", chunk_rows=512, **ESERIES).coefficients()


@register("arx_residuals", f"""WITH {PANEL}, l AS (SELECT *, lag(value) OVER {PW}) AS l FROM panel), {AR1_FIT.format(t='l')}
SELECT {', '.join('l.' + k.strip() for k in PKEYS.split(','))}, {q('l.value', 'value', 2)}, {q('fit.c + fit.phi * l.l', 'fitted', 2)},
  {q('l.value - (fit.c + fit.phi * l.l)', 'residual', 2)} FROM l JOIN fit ON l.series = fit.series""", digits=2)
def _(spark, sf):
    df = panel(spark, sf).drop("quantity")
    return arx_residuals(df, arx_fit(df, AR1, "value", **PSERIES))


AR1_AHEAD = "CASE WHEN abs(1 - phi) < 1e-12 THEN y + h * c ELSE c * (1 - phi ** h) / (1 - phi) + phi ** h * y END"


@register("arx_forecast", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) AS pos, count(*) OVER (PARTITION BY series) AS n,
  lag(value) OVER {PW}) AS l0 FROM panel),
past AS (SELECT *, l0 AS l FROM i WHERE n - pos >= 24), {AR1_FIT.format(t='past')},
last AS (SELECT series, value AS y FROM i WHERE n - pos = 24),
f AS (SELECT i.*, c, phi, y, (24 - (n - pos)) AS h FROM i JOIN fit ON i.series = fit.series JOIN last ON i.series = last.series WHERE n - pos < 24)
SELECT {', '.join(k.strip() for k in PKEYS.split(','))}, {q('value', 'actual', 2)}, {q(AR1_AHEAD, 'predicted', 2)} FROM f""", digits=2)
def _(spark, sf):
    roles = materialize(holdout_tail(panel(spark, sf).drop("quantity"), 24, 10**9, **PSERIES))
    fit = roles.filter("role = 'fit'").drop("role")
    val = roles.filter("role = 'val'").drop("role").withColumn("actual", F.col("value"))
    out = arx_forecast(fit, val, arx_fit(fit, AR1, "value", **PSERIES))
    return out.select("series", "date", "l_orderkey", "l_linenumber", "l_partkey", "actual", "predicted")


# --- conditional sum of squares -----------------------------------------------------
MEAN_FORM = """SELECT series, 'mean' AS term, {mean} FROM fit UNION ALL SELECT series, 'ar_1', {ar} FROM fit"""


def _mean_form(digits):
    return MEAN_FORM.format(mean=q("c / (1 - phi)", "value", digits), ar=q("phi", "value", digits))


# Without a moving average the least sum of squared shocks is that of the regression on the row before.
@register("css_fit", f"""WITH {PANEL}, l AS (SELECT series, value, lag(value) OVER {PW}) AS l FROM panel), {AR1_FIT.format(t='l')} {_mean_form(2)}""", digits=2)
def _(spark, sf):
    return css_fit(panel(spark, sf), AR1, "value", **PSERIES).coefficients()


@register("css_fit_long", f"""WITH {EVENTS}, l AS (SELECT series, value, lag(value) OVER {EW}) AS l FROM es), {AR1_FIT.format(t='l')} {_mean_form(4)}""")
def _(spark, sf):
    return css_fit(event_series(spark, sf), AR1, "value", chunk_rows=512, **ESERIES).coefficients()


@register("css_arma", digits=3)
def _(spark, sf):
    return css_fit(panel(spark, sf), ArxSpec(p=1, q=1), "value", **PSERIES).coefficients()


@register("css_arma_long", digits=3)
def _(spark, sf):
    return css_fit(event_series(spark, sf), ArxSpec(p=0, q=2), "value", chunk_rows=512, **ESERIES).coefficients()


@register("css_armax", digits=3)
def _(spark, sf):
    return css_fit(panel(spark, sf), ArxSpec(p=1, q=1, exog=("quantity",)), "value", **PSERIES).coefficients()


@register("css_sarima", digits=3)
def _(spark, sf):
    hourly = event_series(spark, sf)
    return css_fit(hourly, ArxSpec(p=1, q=1, P=1, D=1, Q=1, m=24, intercept=False), "value", **ESERIES).coefficients()


# Shocks and forecasts of given parameters: SQL runs the recurrence one row after another.
GIVEN = ArxSpec(p=1, d=1, q=1, intercept=False)
PHI, THETA = 0.4, 0.3
WALKED = f"""{PANEL}, i AS (SELECT *, row_number() OVER {PW}) AS pos, count(*) OVER (PARTITION BY series) AS n, value - lag(value) OVER {PW}) AS z FROM panel),
past AS (SELECT *, z - {PHI} * lag(z) OVER {PW}) AS r FROM i WHERE n - pos >= {{held}}),
walk AS (SELECT series, pos, r AS e FROM past WHERE pos = 3
  UNION ALL SELECT p.series, p.pos, p.r - {THETA} * w.e FROM walk w JOIN past p ON p.series = w.series AND p.pos = w.pos + 1)"""


def _given(df):
    beta = df.select("series").distinct().select("series", F.array(F.lit(PHI), F.lit(THETA)).alias("beta"), F.lit(0).cast("long").alias("nobs"), F.lit(0.0).alias("sigma2"))
    return CssModel(GIVEN, ("series",), PANEL_ORDER, "value", beta, beta.count())


@register("css_residuals", f"""WITH RECURSIVE {WALKED.format(held=0)}
SELECT {', '.join('p.' + k.strip() for k in PKEYS.split(','))}, {q('p.value', 'value', 2)}, {q('p.value - w.e', 'fitted', 2)}, {q('w.e', 'residual', 2)}
FROM past p LEFT JOIN walk w ON p.series = w.series AND p.pos = w.pos""", digits=2)
def _(spark, sf):
    df = panel(spark, sf).drop("quantity")
    return css_residuals(df, _given(df), chunk_rows=200)


@register("css_forecast", f"""WITH RECURSIVE {WALKED.format(held=24)},
last AS (SELECT p.series, p.value AS y, {PHI} * p.z + {THETA} * w.e AS z1 FROM past p JOIN walk w ON p.series = w.series AND p.pos = w.pos WHERE n - p.pos = 24)
SELECT {', '.join('i.' + k.strip() for k in PKEYS.split(','))}, {q('i.value', 'actual', 2)},
  {q(f'y + z1 * (1 - {PHI} ** (24 - (n - pos))) / (1 - {PHI})', 'predicted', 2)}
FROM i JOIN last ON i.series = last.series WHERE n - pos < 24""", digits=2)
def _(spark, sf):
    roles = materialize(holdout_tail(panel(spark, sf).drop("quantity"), 24, None, **PSERIES))
    past, ahead = (roles.filter(F.col("role") == r).drop("role") for r in ("fit", "val"))
    out = css_forecast(past, ahead.withColumn("actual", F.col("value")), _given(past), chunk_rows=200, steps=10)
    return out.select("series", "date", "l_orderkey", "l_linenumber", "l_partkey", "actual", "predicted")


@register("holdout_eval", f"""WITH {EVENTS}, i AS (SELECT *, row_number() OVER {EW}) AS pos, count(*) OVER (PARTITION BY series) AS n,
  lag(value) OVER {EW}) AS l FROM es),
past AS (SELECT * FROM i WHERE n - pos >= 48), {AR1_FIT.format(t='past')},
last AS (SELECT series, value AS y FROM i WHERE n - pos = 48),
f AS (SELECT i.series, value AS actual, c, phi, y, (48 - (n - pos)) AS h FROM i JOIN fit ON i.series = fit.series JOIN last ON i.series = last.series WHERE n - pos < 48),
p AS (SELECT series, actual, {AR1_AHEAD} AS predicted FROM f)
SELECT series, count(*) AS n, {q('avg(abs(predicted - actual))', 'mae')}, {q('sqrt(avg((predicted - actual) ** 2))', 'rmse')},
  {q('1 - avg((predicted - actual) ** 2) / var_pop(actual)', 'r2')},
  {q('avg(((actual > 0) = (predicted > 0))::INTEGER)', 'directional_accuracy')} FROM p GROUP BY series""")
def _(spark, sf):
    return holdout_eval(event_series(spark, sf), AR1, "value", 48, None, **ESERIES)[1]


def scaled_market(spark, sf):
    train = market_train(spark, sf)
    stats = fit_scaler(train, ("load",))
    return scale_train(train, stats, ("load",)), stats


@register("walk_forward_cv_single", f"""WITH {TRAIN}, {BOUNDS_DAYS},
s AS (SELECT date, spread, (load - avg(load) OVER ()) / stddev_pop(load) OVER () AS x,
  (spread - avg(spread) OVER ()) / stddev_pop(spread) OVER () AS y, avg(spread) OVER () AS m, stddev_pop(spread) OVER () AS sd FROM train),
r AS (SELECT s.*, b.fold_id, CASE WHEN s.date < b.val_start THEN 'train' ELSE 'val' END AS role
  FROM s, bounds b WHERE s.date < b.val_start OR s.date < b.val_end OR (b.fold_id = 4 AND s.date <= b.val_end)),
size AS (SELECT fold_id, count(*) FILTER (WHERE role = 'train') AS train_rows, count(*) FILTER (WHERE role = 'val') AS val_rows,
  strftime(min(date) FILTER (WHERE role = 'train'), '%Y-%m-%d') AS train_start, strftime(max(date) FILTER (WHERE role = 'train'), '%Y-%m-%d') AS train_end,
  strftime(min(date) FILTER (WHERE role = 'val'), '%Y-%m-%d') AS val_start, strftime(max(date) FILTER (WHERE role = 'val'), '%Y-%m-%d') AS val_end FROM r GROUP BY 1),
ok AS (SELECT *, row_number() OVER (ORDER BY fold_id)::INTEGER AS fold FROM size WHERE train_rows >= 96 AND val_rows >= 96),
fit AS (SELECT fold_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r WHERE role = 'train' GROUP BY 1),
tl AS (SELECT r.fold_id, avg((y - a - b * x) ** 2) AS train_loss FROM r JOIN fit ON r.fold_id = fit.fold_id WHERE role = 'train' GROUP BY 1),
v AS (SELECT *, row_number() OVER (PARTITION BY fold_id ORDER BY date) AS pos FROM r WHERE role = 'val'),
p AS (SELECT v.fold_id, v.spread AS actual, m + sd * (a + b * x) AS predicted, y - a - b * x AS e FROM v JOIN fit ON v.fold_id = fit.fold_id WHERE pos >= 96),
vm AS (SELECT fold_id, count(*) AS scored_rows, avg(e * e) AS val_loss, avg(abs(predicted - actual)) AS val_mae,
  sqrt(avg((predicted - actual) ** 2)) AS val_rmse, 1 - avg((predicted - actual) ** 2) / var_pop(actual) AS val_r2 FROM p GROUP BY 1)
SELECT fold AS fold_id, train_start, train_end, val_start, val_end, train_rows, val_rows, scored_rows, {q('train_loss')},
  {q('val_loss')}, {q('val_mae')}, {q('val_rmse')}, {q('val_r2')}, {q('val_loss - train_loss', 'overfit_gap')}
FROM ok JOIN tl ON ok.fold_id = tl.fold_id JOIN vm ON ok.fold_id = vm.fold_id""")
def _(spark, sf):
    scaled, stats = scaled_market(spark, sf)
    return walk_forward_cv(scaled, bounds_list(scaled, days=4), ("load",), stats=stats, penalty=0.0)


# Errors far below ``delta`` make the reweighted fit the least-squares one, which SQL can give.
@register("refit_per_fold", f"""SELECT *, 2 AS iterations FROM ({{}})""".format(ORACLES["walk_forward_cv_single"]))
def _(spark, sf):
    scaled, stats = scaled_market(spark, sf)
    return refit_per_fold(scaled, bounds_list(scaled, days=4), ("load",), model=Huber(delta=1e6), stats=stats)


@register("refit_robust", digits=3)
def _(spark, sf):
    scaled, stats = scaled_market(spark, sf)
    return refit_per_fold(scaled, bounds_list(scaled, days=4), ("load",), model=Huber(delta=0.5), stats=stats)


def _prepared(spark, sf):
    return prepare(market_train(spark, sf), market_imbalances(spark, sf), market_test(spark, sf))


@register("walk_forward_cv", digits=3)
def _(spark, sf):
    p = _prepared(spark, sf)
    return walk_forward_cv(p.train, bounds_list(p.train, days=4), FEATURES, stats=p.scaler)


def window_mean(windows: np.ndarray) -> np.ndarray:
    """A predictor whose answer SQL can give too: the mean of the first feature over the window."""
    return windows[:, :, 0].astype(float).mean(1)


@register("score_windows", f"""WITH {MARKET}, {TEST}, s AS (SELECT "ID", date,
  avg(wind::FLOAT) OVER (ORDER BY date ROWS BETWEEN 95 PRECEDING AND CURRENT ROW) AS m, row_number() OVER (ORDER BY date) AS pos FROM test)
SELECT "ID", date, {q('CASE WHEN pos >= 96 THEN m END', 'predicted', 2)} FROM s""", digits=2)
def _(spark, sf):
    return score_windows(market_test(spark, sf), ("wind", "load"), window_mean, keep=("ID",)).select("ID", "date", "predicted")


@register("score_windows_long", f"""WITH {EVENTS}, s AS (SELECT series, ts, event_id,
  avg(value::FLOAT) OVER {EW} ROWS BETWEEN 95 PRECEDING AND CURRENT ROW) AS m, row_number() OVER {EW}) AS pos FROM es)
SELECT series, ts, event_id, {q('CASE WHEN pos >= 96 THEN m END', 'predicted', 2)} FROM s""", digits=2)
def _(spark, sf):
    return score_windows(event_series(spark, sf), ("value",), window_mean, chunk_rows=512, **ESERIES)


@register("align_predictions", f"""WITH {MARKET}, {TEST}, s AS (SELECT "ID", date, wind - solar AS w, row_number() OVER (ORDER BY date) AS pos FROM test)
SELECT "ID", date, {q('CASE WHEN pos >= 96 THEN w ELSE (SELECT w FROM s WHERE pos = 96) END', 'predicted')} FROM s""")
def _(spark, sf):
    test = market_test(spark, sf)
    late = test.filter(F.col("ID") >= 95).select("date", (F.col("wind") - F.col("solar")).alias("predicted"))
    return align_predictions(test.select("ID", "date"), late)


@register("prepare_features", digits=3)
def _(spark, sf):
    return _prepared(spark, sf).train


@register("prepare_short", digits=3)
def _(spark, sf):
    short = prepare(market_train(spark, sf), market_imbalances(spark, sf), market_test(spark, sf), with_windows=False)
    return short.test


@register("forecast_submission", digits=4)
def _(spark, sf):
    return forecast_prepared(_prepared(spark, sf)).submission


def _classical(family):
    @register(f"{family}_submission", digits=4)
    def _(spark, sf):
        return classical_forecast(market_train(spark, sf), market_test(spark, sf), family)[0]


for _family in ("arima", "arimax", "sarima"):
    _classical(_family)
