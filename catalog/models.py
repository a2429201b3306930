"""Regimes, calibration, histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.operators.calibrate import (
    Calibrator, calibrate_apply, calibrate_fit, calibration_summary, sigmoid_temperature,
)
from slotcast.operators.evaluate import directional_accuracy
from slotcast.operators.history import best_epoch, early_stop_select, overfit_gap
from slotcast.operators.regimes import (
    Regimes, assign_regimes, fit_regimes, kmeans_elbow, regime_counts, regime_number, regime_scatter, regime_summary,
)
from slotcast.schema import CORE
from slotcast.sources.sampletables import history, table

from . import q, register
from .samples import STEP1_CTE, step1_scaled
from .statistics import PREDICTED, predictions

# --- fixed values: given centres of scaled wind, solar, load, so that labels have an exact SQL equivalent ---
CENTRES = (
    (-0.8, -0.8, -1.0), (-0.5, 0.9, 0.2), (0.0, 0.0, 2.0), (0.9, -0.5, 0.1), (1.5, 1.5, 1.2),
)
GIVEN = Regimes(CORE, CENTRES, 0.0)
_D = [" + ".join(f"({c} - ({v})) ** 2" for c, v in zip(CORE, centre)) for centre in CENTRES]
LABELLED = f"""{STEP1_CTE},
dist AS (SELECT *, [{', '.join(_D)}] AS d FROM train_s),
lab AS (SELECT *, (list_position(d, list_min(d)) - 1)::INTEGER AS market_regime FROM dist)"""


def labelled(spark, sf):
    return assign_regimes(step1_scaled(spark, sf)[0], GIVEN)


@register("regime_assign", f"""WITH {LABELLED} SELECT date, market_regime,
  {', '.join(f'(market_regime = {i})::INTEGER AS regime_{i}' for i in range(5))} FROM lab""")
def _(spark, sf):
    return labelled(spark, sf).select("date", "market_regime", *[f"regime_{i}" for i in range(5)])


@register("regime_summary", f"""WITH {LABELLED} SELECT market_regime, count(*) AS rows, {q('avg(spread)', 'target_mean')},
  {q('stddev_samp(spread)', 'target_std')}, {q('count(*) * 100.0 / sum(count(*)) OVER ()', 'share_pct')} FROM lab GROUP BY 1""")
def _(spark, sf):
    return regime_summary(labelled(spark, sf))


@register("regime_counts", f"WITH {LABELLED} SELECT market_regime, count(*) AS rows FROM lab GROUP BY 1")
def _(spark, sf):
    return regime_counts(labelled(spark, sf))


@register("regime_number", f"WITH {LABELLED} SELECT count(DISTINCT market_regime) AS regimes FROM lab")
def _(spark, sf):
    return regime_number(labelled(spark, sf))


def _cell(c):
    return (f"least(floor(({c} - (SELECT min({c}) FROM lab)) / ((SELECT max({c}) FROM lab) - (SELECT min({c}) FROM lab)) * 20), 19)"
            "::INTEGER")


@register("regime_scatter", f"""WITH {LABELLED}, u AS ({' UNION ALL '.join(
    f"SELECT '{a}_{b}' AS panel, market_regime, {_cell(a)} AS x_cell, {_cell(b)} AS y_cell FROM lab"
    for a, b in (('wind', 'solar'), ('load', 'spread'), ('wind', 'load')))})
SELECT panel, market_regime, x_cell, y_cell, count(*) AS points FROM u GROUP BY ALL""")
def _(spark, sf):
    return regime_scatter(labelled(spark, sf), 20)


@register("kmeans_elbow", digits=2)
def _(spark, sf):
    return kmeans_elbow(step1_scaled(spark, sf)[0])


@register("kmeans_fit", digits=2)
def _(spark, sf):
    return fit_regimes(step1_scaled(spark, sf)[0]).to_frame(spark)


@register("calibrate_fit", digits=4)
def _(spark, sf):
    return calibrate_fit(predictions(spark, sf)).to_frame(spark)


CAL = Calibrator(0.0001, -0.05, None)


@register("calibrate_apply", f"""WITH {PREDICTED} SELECT l_orderkey, l_linenumber, l_partkey,
  {q('1 / (1 + exp(-(predicted * 0.0001 - 0.05)))', 'probability', 6)} FROM pred""", digits=6)
def _(spark, sf):
    return calibrate_apply(predictions(spark, sf), CAL).select("l_orderkey", "l_linenumber", "l_partkey", "probability")


@register("sigmoid_temperature", f"""WITH {PREDICTED} SELECT l_orderkey, l_linenumber, l_partkey,
  {q('1 / (1 + exp(-predicted / (SELECT greatest(stddev_pop(predicted), 1e-8) FROM pred)))', 'probability', 6)} FROM pred""", digits=6)
def _(spark, sf):
    return sigmoid_temperature(predictions(spark, sf)).select("l_orderkey", "l_linenumber", "l_partkey", "probability")


@register("calibration_summary", f"""WITH {PREDICTED}, p AS (SELECT *, 1 / (1 + exp(-(predicted * 0.0001 - 0.05))) AS probability FROM pred)
SELECT {q('0.0001', 'coef', 6)}, {q('-0.05', 'intercept', 6)},
  {q('avg(((actual > 0) = (predicted > 0))::INTEGER)', 'directional_accuracy', 6)},
  {q('min(probability)', 'p_min', 6)}, {q('max(probability)', 'p_max', 6)}, {q('avg(probability)', 'p_mean', 6)} FROM p""", digits=6)
def _(spark, sf):
    rows = predictions(spark, sf)
    fitted = Calibrator(CAL.coef, CAL.intercept, directional_accuracy(rows).first()[0])
    return calibration_summary(calibrate_apply(rows, fitted), fitted)


HISTORY = """monthly AS (SELECT o_orderpriority AS run_id, year(o_orderdate) * 12 + month(o_orderdate) AS m,
  avg(o_totalprice / 1e5) FILTER (WHERE o_orderstatus = 'F') AS train_loss,
  avg(o_totalprice / 1e5) FILTER (WHERE o_orderstatus = 'O') AS val_loss FROM orders GROUP BY 1, 2),
h AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY m)::INTEGER AS epoch, train_loss, val_loss
  FROM monthly WHERE train_loss IS NOT NULL AND val_loss IS NOT NULL)"""


@register("overfit_gap", f"""WITH {HISTORY} SELECT run_id, epoch, {q('train_loss', None, 6)}, {q('val_loss', None, 6)},
  {q('val_loss - train_loss', 'overfit_gap', 6)} FROM h""", digits=6)
def _(spark, sf):
    return overfit_gap(history(spark, sf))


@register("best_epoch", f"""WITH {HISTORY} SELECT run_id, arg_min(epoch, (val_loss, epoch)) AS best_epoch,
  {q('min(val_loss)', 'best_val_loss', 6)} FROM h GROUP BY 1""", digits=6)
def _(spark, sf):
    return best_epoch(history(spark, sf))


@register("early_stop_select", f"""WITH RECURSIVE {HISTORY},
walk AS (
  SELECT run_id, 0 AS last, 'infinity'::DOUBLE AS best, 0 AS best_epoch, NULL::DOUBLE AS gap, 0 AS waited FROM (SELECT DISTINCT run_id FROM h)
  UNION ALL
  SELECT w.run_id, h.epoch, CASE WHEN h.val_loss < w.best - 1e-4 THEN h.val_loss ELSE w.best END,
    CASE WHEN h.val_loss < w.best - 1e-4 THEN h.epoch ELSE w.best_epoch END,
    CASE WHEN h.val_loss < w.best - 1e-4 THEN h.val_loss - h.train_loss ELSE w.gap END,
    CASE WHEN h.val_loss < w.best - 1e-4 THEN 0 ELSE w.waited + 1 END
  FROM walk w JOIN h ON h.run_id = w.run_id AND h.epoch = w.last + 1 WHERE w.waited < 10),
ends AS (SELECT run_id, max(last) AS last FROM walk GROUP BY 1)
SELECT w.run_id, w.best_epoch::INTEGER AS best_epoch, {q('w.best', 'best_val_loss', 6)}, {q('w.gap', 'gap_at_best', 6)},
  w.last::INTEGER AS epochs_run, w.waited >= 10 AS stopped_early
FROM walk w JOIN ends e ON w.run_id = e.run_id AND w.last = e.last""", digits=6)
def _(spark, sf):
    return early_stop_select(history(spark, sf))


__all__ = ["F", "table"]
