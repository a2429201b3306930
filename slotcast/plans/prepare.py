"""Feature preparation: from raw market tables to scaled train and test tables with regimes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.calendar import temporal_features
from ..functions.domain import domain_features
from ..operators.grid import merge_imbalances
from ..operators.regimes import Regimes, assign_regimes, fit_regimes
from ..operators.scaling import ScalerStats, fit_scaler, scale_test, scale_train
from ..operators.timeline import plan_layout
from ..operators.windows import lag_and_roll
from ..schema import REGIME_INITS, SCALED, SCALED_STEP1
from ..session import materialize


@dataclass
class Prepared:
    train: DataFrame       # scaled, with regimes and spread_scaled
    test: DataFrame
    featured: DataFrame    # train before scaling
    scaler: ScalerStats
    regimes: Regimes


def step1_features(df: DataFrame) -> DataFrame:
    return domain_features(temporal_features(df))


def featured(df: DataFrame, series=(), order=("date",), chunk_rows: int | None = None) -> DataFrame:
    """Calendar and domain columns, filled lags and rolling statistics of raw values: one shuffle, one sort."""
    base = step1_features(df)
    # sizes are read from the narrow input, before the derived columns exist
    layout = plan_layout(df, series, order, chunk_rows)
    return lag_and_roll(base, layout=layout)


def prepare(train: DataFrame, imbalances: DataFrame, test: DataFrame, with_windows: bool = True,
            inits: int = REGIME_INITS, chunk_rows: int | None = None) -> Prepared:
    """Steps in the order the model needs: windows on raw values, scaler on train only, regimes on scaled values.

    ``with_windows=False`` is the short preparation without lags and rolling statistics.
    """
    merged = merge_imbalances(train, imbalances)
    if with_windows:
        # read by the scaler, the clustering and the result: computed once
        made = materialize(featured(merged, chunk_rows=chunk_rows))
        made_test, columns = featured(test, chunk_rows=chunk_rows), SCALED
    else:
        made, made_test, columns = step1_features(merged), step1_features(test), SCALED_STEP1
    scaler = fit_scaler(made, columns)
    train_scaled, test_scaled = scale_train(made, scaler, columns), scale_test(made_test, scaler, columns)
    regimes = fit_regimes(train_scaled, inits=inits)
    return Prepared(
        assign_regimes(train_scaled, regimes), assign_regimes(test_scaled, regimes), made, scaler, regimes
    )
