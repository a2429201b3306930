"""Writers and saved state: written to the shared checkpoint folder, read back and compared."""

from __future__ import annotations

import uuid

from slotcast.operators.autoreg import ArxSpec, arx_fit
from slotcast.operators.folds import bounds_list
from slotcast.operators.history import overfit_gap
from slotcast.operators.linear import fit_ridge, walk_forward_cv
from slotcast.operators.scaling import fit_scaler
from slotcast.schema import SCALED_STEP1
from slotcast.session import ensure_checkpoint_dir
from slotcast.sources.models import load_model, model_numbers, save_model
from slotcast.sources.sampletables import history, market_test, panel
from slotcast.sources.sinks import (
    load_scaler, read_prepared, read_versioned, save_state, write_cv, write_history, write_prepared, write_submission,
)
from pyspark.sql import functions as F

from . import ORACLES, q, qs, register
from .features import SCALED_SHOWN
from .forecasts import AR1, PSERIES, scaled_market
from .samples import MARKET, STEP1_CTE, STEP1_SCALED, TEST, step1_scaled, step1_tables


def fresh(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("write_prepared", f"WITH {STEP1_CTE} SELECT date, {qs([*SCALED_SHOWN, 'spread', 'spread_scaled'])} FROM train_s")
def _(spark, sf):
    path = fresh(spark, "prepared")
    write_prepared(step1_scaled(spark, sf)[0], path)
    return read_prepared(spark, path).select("date", *SCALED_SHOWN, "spread", "spread_scaled")


@register("write_submission", f"""WITH {MARKET}, {TEST}
SELECT "ID", {q('1 / (1 + exp(-(wind - solar) / 50.0))', 'forecast', 6)} FROM test""", digits=6)
def _(spark, sf):
    path = fresh(spark, "submission")
    write_submission(
        market_test(spark, sf).withColumn("probability", 1 / (1 + F.exp(-(F.col("wind") - F.col("solar")) / 50.0))), path)
    return spark.read.schema("ID bigint, forecast double").option("header", True).csv(path)


@register("write_history", None, digits=6)
def _(spark, sf):
    path = fresh(spark, "history")
    write_history(overfit_gap(history(spark, sf)), path)
    return read_versioned(spark, path)


@register("write_cv", digits=4)
def _(spark, sf):
    path = fresh(spark, "cv")
    scaled, stats = scaled_market(spark, sf)
    folds = walk_forward_cv(scaled, bounds_list(scaled, days=4), ("load",), stats=stats, penalty=0.0)
    folds = folds.withColumn("best_epoch", F.lit(1))  # solved in one pass
    write_cv(folds.limit(1), path)
    write_cv(folds, path)  # readers follow the pointer to the later version
    return read_versioned(spark, path)


@register("save_state", f"""WITH {STEP1_CTE} {' UNION ALL '.join(
    f"SELECT '{c}' AS column, {q(f'avg({c})', 'mean')}, {q(f'coalesce(nullif(stddev_pop({c}), 0), 1)', 'scale')} FROM train1"
    for c in [*STEP1_SCALED, 'spread'])}""")
def _(spark, sf):
    path = fresh(spark, "state")
    save_state(spark, path, scaler=fit_scaler(step1_tables(spark, sf)[0], SCALED_STEP1))
    return load_scaler(spark, path).to_frame(spark)


@register("save_model", digits=3)
def _(spark, sf):
    path = fresh(spark, "model")
    save_model(spark, arx_fit(panel(spark, sf), ArxSpec(p=2), "value", **PSERIES), path)
    save_model(spark, arx_fit(panel(spark, sf), AR1, "value", **PSERIES), path)  # readers get the later one
    return load_model(spark, path).coefficients()


@register("save_ridge", f"""WITH {STEP1_CTE} SELECT 'const' AS term, {q('regr_intercept(spread_scaled, load)', 'value')} FROM train_s
UNION ALL SELECT 'x_load', {q('regr_slope(spread_scaled, load)', 'value')} FROM train_s""")
def _(spark, sf):
    path = fresh(spark, "ridge")
    save_model(spark, fit_ridge(step1_scaled(spark, sf)[0], ("load",), penalty=0.0), path)
    return model_numbers(load_model(spark, path), spark)


# the written history is the table the gap query gives
from . import models  # noqa: E402,F401

ORACLES["save_model"] = ORACLES["arx_fit"]
ORACLES["write_history"] = ORACLES["overfit_gap"]
ORACLES["write_cv"] = f"""SELECT fold_id, train_start, train_end, val_start, val_end, train_rows, val_rows, 1::INTEGER AS best_epoch,
  val_mae, val_rmse, val_r2, overfit_gap FROM ({ORACLES["walk_forward_cv_single"]})"""
