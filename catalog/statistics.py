"""Distribution and dependence of the target, error metrics, plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.functions.domain import domain_features
from slotcast.operators.evaluate import (
    cv_summary, directional_accuracy, error_metrics, fold_bars, prediction_bounds, probability_summary, residuals,
)
from slotcast.operators.gram import correlation_matrix
from slotcast.operators.stats import (
    acf, acf_bars, autocorrelation, box_summary, center_marks, histogram, lag_correlation, pacf, target_stats,
)
from slotcast.operators.windows import fill_lags, lag_features
from slotcast.sources.sampletables import PANEL_ORDER, event_series, market_train, panel, table

from . import q, qs, register
from .samples import DOMAIN_SQL, EVENTS, PANEL, TRAIN
from .windows import EW, PW, filled_sql

STATS = """count(*) AS count, {mean}, {std}, {min}, {q1}, {median}, {q3}, {max}, {skewness}, {kurtosis}, {iqr},
  {pct_positive}, {pct_negative}, {pct_zero}"""


def _stats_sql(c: str) -> str:
    parts = {
        "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "q1": f"quantile_cont({c}, 0.25)",
        "median": f"quantile_cont({c}, 0.5)", "q3": f"quantile_cont({c}, 0.75)", "max": f"max({c})",
        "skewness": f"skewness({c})", "kurtosis": f"kurtosis({c})",
        "iqr": f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)",
        "pct_positive": f"count(*) FILTER (WHERE {c} > 0) * 100.0 / count(*)",
        "pct_negative": f"count(*) FILTER (WHERE {c} < 0) * 100.0 / count(*)",
        "pct_zero": f"count(*) FILTER (WHERE {c} = 0) * 100.0 / count(*)",
    }
    return STATS.format(**{k: q(e, k) for k, e in parts.items()})


@register("target_stats", f"WITH {TRAIN} SELECT {_stats_sql('spread')} FROM train")
def _(spark, sf):
    return target_stats(market_train(spark, sf))


@register("target_stats_large", f"SELECT {_stats_sql('l_extendedprice')} FROM lineitem")
def _(spark, sf):
    return target_stats(table(spark, sf, "lineitem"), "l_extendedprice")


@register("target_stats_series", f"WITH {PANEL} SELECT series, {_stats_sql('value')} FROM panel GROUP BY series")
def _(spark, sf):
    return target_stats(panel(spark, sf), "value", ("series",))


# Every series counts as large here: all are narrowed together.
@register("target_stats_series_large", f"WITH {PANEL} SELECT series, {_stats_sql('value')} FROM panel GROUP BY series")
def _(spark, sf):
    return target_stats(panel(spark, sf), "value", ("series",), small=50)


ACF_LAGS = (1, 2, 4, 8, 48, 96, 192)


def _lag_cols(c, lags, w):
    return ", ".join(f"lag({c}, {k}) OVER {w}) AS y{k}" for k in lags)


def _corr_union(lags, source, c, keys=""):
    group = f" GROUP BY {keys.rstrip(', ')}" if keys else ""
    return " UNION ALL ".join(
        f"SELECT {keys}{k}::INTEGER AS lag, {q(f'corr({c}, y{k})', 'r', 6)} FROM {source}{group}" for k in lags)


@register("autocorrelation", f"""WITH {TRAIN}, l AS (SELECT spread, {_lag_cols('spread', ACF_LAGS, '(ORDER BY date')} FROM train)
{_corr_union(ACF_LAGS, 'l', 'spread')}""", digits=6)
def _(spark, sf):
    return autocorrelation(market_train(spark, sf))


@register("autocorrelation_series", f"""WITH {EVENTS}, l AS (SELECT series, value, {_lag_cols('value', ACF_LAGS, EW)} FROM es)
{_corr_union(ACF_LAGS, 'l', 'value', 'series, ')}""", digits=6)
def _(spark, sf):
    return autocorrelation(event_series(spark, sf), "value", series=("series",), order=("ts", "event_id"), chunk_rows=512)


@register("acf_bars", f"""WITH {TRAIN}, l AS (SELECT spread, {_lag_cols('spread', ACF_LAGS, '(ORDER BY date')} FROM train),
r AS ({_corr_union(ACF_LAGS, 'l', 'spread')})
SELECT lag, r, lag IN (1, 4, 96) AS selected, CASE lag WHEN 1 THEN '15min' WHEN 4 THEN '1h' WHEN 96 THEN '24h' END AS label
FROM r""", digits=6)
def _(spark, sf):
    return acf_bars(autocorrelation(market_train(spark, sf)))


def _acf_sql(nlags, keys=""):
    group = f" GROUP BY {keys.rstrip(', ')}" if keys else ""
    return " UNION ALL ".join(
        f"SELECT {keys}{k}::INTEGER AS lag, {q(f'sum(c * c{k}) / sum(c * c)' if k else 'sum(c * c) / sum(c * c)', 'r', 6)} FROM l{group}"
        for k in range(nlags + 1))


@register("acf", f"""WITH {TRAIN}, w AS (SELECT * FROM train),
d AS (SELECT date, spread - (SELECT avg(spread) FROM w) AS c FROM w),
l AS (SELECT c, {', '.join(f'lag(c, {k}) OVER (ORDER BY date) AS c{k}' for k in range(1, 11))} FROM d)
{_acf_sql(10)}""", digits=6)
def _(spark, sf):
    return acf(market_train(spark, sf))


@register("acf_series", f"""WITH {EVENTS}, d AS (SELECT series, ts, event_id,
  value - avg(value) OVER (PARTITION BY series) AS c FROM es),
l AS (SELECT series, c, {', '.join(f'lag(c, {k}) OVER {EW}) AS c{k}' for k in range(1, 6))} FROM d)
{_acf_sql(5, 'series, ')}""", digits=6)
def _(spark, sf):
    return acf(event_series(spark, sf), "value", 5, series=("series",), order=("ts", "event_id"), chunk_rows=512)


# partial autocorrelation by Yule-Walker has a closed form at orders 1 and 2
def _gamma(k, source):
    return f"(SELECT sum(c * c{k}) / (count(*) - {k}) FROM {source})" if k else f"(SELECT sum(c * c) / count(*) FROM {source})"


@register("pacf_short", f"""WITH {TRAIN}, d AS (SELECT date, spread - (SELECT avg(spread) FROM train) AS c FROM train),
l AS (SELECT c, lag(c, 1) OVER (ORDER BY date) AS c1, lag(c, 2) OVER (ORDER BY date) AS c2 FROM d),
g AS (SELECT {_gamma(1, 'l')} / {_gamma(0, 'l')} AS r1, {_gamma(2, 'l')} / {_gamma(0, 'l')} AS r2)
SELECT 0::INTEGER AS lag, {q('1.0', 'r', 6)} UNION ALL SELECT 1, {q('r1', 'r', 6)} FROM g
UNION ALL SELECT 2, {q('(r2 - r1 * r1) / (1 - r1 * r1)', 'r', 6)} FROM g""", digits=6)
def _(spark, sf):
    return pacf(market_train(spark, sf), nlags=2, last_rows=None)


@register("pacf", digits=6)
def _(spark, sf):
    return pacf(market_train(spark, sf))


@register("pacf_plot", digits=6)
def _(spark, sf):
    return pacf(event_series(spark, sf), "value", 40, "ywm", series=("series",), order=("ts", "event_id"))


@register("lag_correlation", f"""WITH {TRAIN}, l AS (SELECT date, spread,
  {', '.join(f'lag(spread, {k}) OVER (ORDER BY date) AS l{k}' for k in (1, 4, 96))} FROM train),
f AS (SELECT spread, {', '.join(f"{filled_sql(f'l{k}', '(ORDER BY date')} AS y{k}" for k in (1, 4, 96))} FROM l)
{_corr_union((1, 4, 96), 'f', 'spread')}""", digits=6)
def _(spark, sf):
    cols = [f"spread_lag_{k}" for k in (1, 4, 96)]
    return lag_correlation(fill_lags(lag_features(market_train(spark, sf), ("spread",)), cols))


CORR = ["wind", "solar", "load", "net_load", "renewable_ratio", "wind_solar_ratio", "total_renewable", "spread"]


@register("correlation_matrix", f"""WITH {TRAIN}, f AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in DOMAIN_SQL.items())} FROM train)
{' UNION ALL '.join(f"SELECT '{a}' AS x, '{b}' AS y, {q(f'corr({a}, {b})', 'r', 6)} FROM f" for a in CORR for b in CORR)}""", digits=6)
def _(spark, sf):
    return correlation_matrix(domain_features(market_train(spark, sf)), CORR)


MISSING = "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END"
LCORR = ["l_quantity", "l_extendedprice", "discount", "l_tax"]


@register("correlation_matrix_large", f"""WITH f AS (SELECT *, {MISSING} AS discount FROM lineitem)
{' UNION ALL '.join(f"SELECT '{a}' AS x, '{b}' AS y, {q(f'corr({a}, {b})', 'r', 6)} FROM f" for a in LCORR for b in LCORR)}""", digits=6)
def _(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("discount", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_discount")))
    return correlation_matrix(df, LCORR)


HIST = """ends AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}),
counts AS (SELECT least(floor(({c} - lo) / (hi - lo) * 200), 199)::INTEGER AS bin, count(*) AS count FROM {t}, ends GROUP BY 1)
SELECT b.bin::INTEGER AS bin, {left}, {right}, coalesce(c.count, 0) AS count
FROM (SELECT unnest(range(200)) AS bin) b CROSS JOIN ends LEFT JOIN counts c ON b.bin = c.bin"""
HIST_EDGES = dict(left=q("lo + b.bin * ((hi - lo) / 200)", "left"), right=q("lo + (b.bin + 1) * ((hi - lo) / 200)", "right"))


@register("histogram", f"WITH {TRAIN}, " + HIST.format(c="spread", t="train", **HIST_EDGES))
def _(spark, sf):
    return histogram(market_train(spark, sf))


PREDICTED = """pred AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_shipdate,
  l_extendedprice - 40000 AS actual, l_quantity * 1500 - 40000 AS predicted FROM lineitem)"""


def predictions(spark, sf):
    """A crude price forecast from the quantity, centred so that both signs occur."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate",
        (F.col("l_extendedprice") - 40000).alias("actual"), (F.col("l_quantity") * 1500 - 40000).alias("predicted"),
    )


@register("histogram_residuals", f"WITH {PREDICTED}, res AS (SELECT predicted - actual AS residual FROM pred), "
          + HIST.format(c="residual", t="res", **HIST_EDGES))
def _(spark, sf):
    return histogram(residuals(predictions(spark, sf)), "residual")


@register("center_marks", f"WITH {TRAIN} SELECT {q('avg(spread)', 'mean')}, {q('quantile_cont(spread, 0.5)', 'median')} FROM train")
def _(spark, sf):
    return center_marks(market_train(spark, sf))


BOX = """qs AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM {t}),
f AS (SELECT q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qs)
SELECT {q1}, {med}, {q3}, {wl}, {wh}, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers FROM {t}, f"""


def _box(c, t):
    return BOX.format(
        c=c, t=t, q1=q("any_value(q1)", "q1"), med=q("any_value(med)", "median"), q3=q("any_value(q3)", "q3"),
        wl=q(f"least(min({c}) FILTER (WHERE {c} >= lo AND {c} <= hi), any_value(q1))", "whisker_low"),
        wh=q(f"greatest(max({c}) FILTER (WHERE {c} >= lo AND {c} <= hi), any_value(q3))", "whisker_high"))


@register("box_summary", f"WITH {TRAIN}, {_box('spread', 'train')}")
def _(spark, sf):
    return box_summary(market_train(spark, sf))


@register("box_summary_large", f"WITH {_box('value', 'events')}")
def _(spark, sf):
    return box_summary(table(spark, sf, "events"), "value")


ERR = (q("avg(abs(predicted - actual))", "mae"), q("sqrt(avg((predicted - actual) ** 2))", "rmse"),
       q("1 - sum((predicted - actual) ** 2) / (var_pop(actual) * count(*))", "r2"))


@register("error_metrics", f"WITH {PREDICTED} SELECT count(*) AS n, {', '.join(ERR)} FROM pred")
def _(spark, sf):
    return error_metrics(predictions(spark, sf))


@register("error_metrics_by", f"WITH {PREDICTED} SELECT l_returnflag, count(*) AS n, {', '.join(ERR)} FROM pred GROUP BY 1")
def _(spark, sf):
    return error_metrics(predictions(spark, sf), by=("l_returnflag",))


@register("directional_accuracy", f"""WITH {PREDICTED} SELECT l_returnflag,
  {q('avg(((actual > 0) = (predicted > 0))::INTEGER)', 'directional_accuracy', 6)} FROM pred GROUP BY 1""", digits=6)
def _(spark, sf):
    return directional_accuracy(predictions(spark, sf), by=("l_returnflag",))


FOLD_METRICS = f"""fm AS (SELECT year(l_shipdate)::INTEGER AS fold_id, avg(abs(predicted - actual)) AS val_mae,
  sqrt(avg((predicted - actual) ** 2)) AS val_rmse,
  1 - sum((predicted - actual) ** 2) / (var_pop(actual) * count(*)) AS val_r2 FROM pred GROUP BY 1)"""


def fold_metrics(spark, sf):
    by_year = predictions(spark, sf).withColumn("fold_id", F.year("l_shipdate"))
    return error_metrics(by_year, by=("fold_id",)).select(
        "fold_id", F.col("mae").alias("val_mae"), F.col("rmse").alias("val_rmse"), F.col("r2").alias("val_r2"))


@register("cv_summary", f"""WITH {PREDICTED}, {FOLD_METRICS} SELECT count(*) AS folds,
  {', '.join(q(f'avg(val_{m})', f'mean_{m}') + ', ' + q(f'stddev_pop(val_{m})', f'std_{m}') for m in ('mae', 'rmse', 'r2'))} FROM fm""")
def _(spark, sf):
    return cv_summary(fold_metrics(spark, sf))


@register("fold_bars", f"""WITH {PREDICTED}, {FOLD_METRICS}, u AS (
  SELECT fold_id, 'mae' AS metric, val_mae AS value FROM fm UNION ALL SELECT fold_id, 'rmse', val_rmse FROM fm
  UNION ALL SELECT fold_id, 'r2', val_r2 FROM fm)
SELECT fold_id, metric, {q('value')}, {q('avg(value) OVER (PARTITION BY metric)', 'mean')} FROM u""")
def _(spark, sf):
    return fold_bars(fold_metrics(spark, sf))


@register("residuals", f"WITH {PREDICTED} SELECT l_orderkey, l_linenumber, l_partkey, {q('predicted - actual', 'residual')} FROM pred")
def _(spark, sf):
    return residuals(predictions(spark, sf)).select("l_orderkey", "l_linenumber", "l_partkey", "residual")


@register("prediction_bounds", f"""WITH {PREDICTED} SELECT {q('least(min(actual), min(predicted))', 'low')},
  {q('greatest(max(actual), max(predicted))', 'high')}, {ERR[0]}, {ERR[1]} FROM pred""")
def _(spark, sf):
    return prediction_bounds(predictions(spark, sf))


@register("probability_summary", f"""WITH {PREDICTED}, p AS (SELECT *, 1 / (1 + exp(-predicted / 10000.0)) AS probability FROM pred)
SELECT l_returnflag, {q('min(probability)', 'p_min')}, {q('max(probability)', 'p_max')}, {q('avg(probability)', 'p_mean')},
  {q('min(predicted)', 'forecast_min')}, {q('max(predicted)', 'forecast_max')}, {q('avg(predicted)', 'forecast_mean')} FROM p GROUP BY 1""")
def _(spark, sf):
    p = predictions(spark, sf).withColumn("probability", 1 / (1 + F.exp(-F.col("predicted") / 10000.0)))
    return probability_summary(p, by=("l_returnflag",))


__all__ = ["PANEL_ORDER", "PW", "qs"]
