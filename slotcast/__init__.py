"""Time-series features, regimes, folds, forecasts and probabilities as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .functions.calendar import (
    arimax_exog, fourier_arimax, fourier_sarima, sarima_exog, temporal_cyclical, temporal_features, temporal_parts,
)
from .functions.domain import domain_features, nan_to_null, sign_label
from .operators.autoreg import ArxModel, ArxSpec, arx_fit, arx_forecast, arx_residuals
from .operators.calibrate import (
    Calibrator, calibrate_apply, calibrate_fit, calibration_summary, sigmoid_temperature,
)
from .operators.css import CssModel, css_fit, css_forecast, css_residuals
from .operators.evaluate import (
    cv_summary, directional_accuracy, error_metrics, fold_bars, prediction_bounds, probability_summary, residuals,
)
from .operators.folds import bounds_list, fold_bounds, walk_forward_folds
from .operators.gram import correlation_matrix, gram
from .operators.grid import duplicate_slots, median_fill, merge_imbalances, regular_grid, sort_by_date
from .operators.history import best_epoch, early_stop_select, overfit_gap
from .operators.linear import LinearModel, align_predictions, fit_ridge, score_windows, walk_forward_cv
from .operators.quality import data_summary, first_gaps, interval_gaps, interval_report
from .operators.quantiles import exact_quantiles, quantile_table
from .operators.refit import Huber, SignLogit, refit_per_fold
from .operators.regimes import (
    Regimes, assign_regimes, fit_regimes, kmeans_elbow, regime_counts, regime_number, regime_scatter, regime_summary,
)
from .operators.scaling import (
    ScalerStats, exog_stats, fit_scaler, inverse_scale, scale_test, scale_train, scaler_table, scaling_summary,
    standardize_exog, target_range,
)
from .operators.slices import (
    downsample, first_days, first_rows, holdout_tail, last_rows, rolling_band, temporal_split,
)
from .operators.stats import (
    acf, acf_bars, autocorrelation, box_summary, center_marks, histogram, lag_correlation, pacf, target_stats,
)
from .operators.timeline import Layout, Timeline, open_timeline, plan_layout
from .operators.unitroot import adf_test
from .operators.windows import (
    difference, fill_lags, lag_and_roll, lag_features, rolling_features, row_index, sequence_windows, undifference,
    undifference_all,
)
from .plans.forecast import classical_forecast, forecast_prepared, holdout_eval
from .plans.prepare import Prepared, featured, prepare, step1_features
from .session import configure, ensure_checkpoint_dir, local_session
from .sources.market import load_market, load_market_checked, load_prepared, load_test
from .sources.models import load_model, save_model
from .sources.sinks import (
    load_calibrator, load_config, load_regimes, load_scaler, read_prepared, read_versioned, save_state, submission, versions,
    write_cv, write_history, write_prepared, write_submission, write_versioned,
)
