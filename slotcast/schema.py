"""Column groups, table schemas and fixed settings of the time-series model.

The names below are a contract: every operator finds its columns by name and
skips those a table does not have, so one code path serves train and test.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
INTERVAL_MINUTES = 15
SLOTS_PER_DAY = 96
SLOTS_PER_WEEK = 672
SEQUENCE_LENGTH = 96
VALIDATION_FRACTION = 0.2
CV_FOLDS = 4
CV_MONTHS = 6
PATIENCE = 10
MIN_DELTA = 1e-4
REGIMES = 5
REGIME_SEED = 42
REGIME_INITS = 10
REGIME_MAX_ITER = 300
ELBOW_RANGE = tuple(range(2, 11))
ARIMA_TRAIN_ROWS = 35040
ARIMA_HOLDOUT_ROWS = 672
ADF_ROWS = 10000
DAILY_HARMONICS = 3
WEEKLY_HARMONICS = 2
LAG_LABELS = {1: "15min", 4: "1h", 96: "24h"}
LAGS = tuple(LAG_LABELS)
ROLLING = (4, 96)
ACF_LAGS = (1, 2, 4, 8, 48, 96, 192)

# --- column groups ----------------------------------------------------------
DATE = "date"
TARGET = "spread"
TARGET_SCALED = "spread_scaled"
CORE = ("wind", "solar", "load")
TRAIN_ONLY = ("imbalances",)
TEMPORAL_RAW = ("hour", "minute", "day_of_week", "month", "day_of_year", "quarter", "interval_of_day")
TEMPORAL = (
    "hour_sin", "hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos",
    "interval_sin", "interval_cos", "is_weekend",
)
DOMAIN = ("net_load", "renewable_ratio", "wind_solar_ratio", "total_renewable")
LAG_BASE = ("wind", "solar", "load", "net_load")
ROLLING_BASE = ("wind", "solar", "load")


def regime_columns(k: int = REGIMES) -> tuple[str, ...]:
    return tuple(f"regime_{i}" for i in range(k))


def lag_columns(base=LAG_BASE, lags=LAGS) -> tuple[str, ...]:
    return tuple(f"{c}_lag_{k}" for c in base for k in lags)


def rolling_columns(base=ROLLING_BASE, windows=ROLLING) -> tuple[str, ...]:
    return tuple(f"{c}_{stat}_{w}" for stat in ("rmean", "rstd") for c in base for w in windows)


STEP1_FEATURES = CORE + TEMPORAL + DOMAIN + regime_columns()
FEATURES = STEP1_FEATURES + lag_columns() + rolling_columns()
SCALED_STEP1 = CORE + TRAIN_ONLY + DOMAIN
SCALED_TEST = SCALED_STEP1 + lag_columns() + rolling_columns()
SCALED = SCALED_TEST + lag_columns((TARGET,)) + rolling_columns((TARGET,))

# --- table schemas ----------------------------------------------------------
_D = T.DoubleType()
TRAIN_SCHEMA = T.StructType(
    [T.StructField(DATE, T.TimestampNTZType())] + [T.StructField(c, _D) for c in CORE + (TARGET,)]
)
IMBALANCES_SCHEMA = T.StructType([T.StructField(DATE, T.TimestampNTZType()), T.StructField("imbalances", _D)])
TEST_SCHEMA = T.StructType(
    [T.StructField("ID", T.LongType()), T.StructField(DATE, T.TimestampNTZType())]
    + [T.StructField(c, _D) for c in CORE]
)
SAMPLE_SCHEMA = T.StructType([T.StructField("ID", T.LongType()), T.StructField("forecast", _D)])


@dataclass(frozen=True)
class FeatureConfig:
    """Names a later step needs to find its columns in the prepared tables."""

    core: tuple[str, ...] = CORE
    temporal: tuple[str, ...] = TEMPORAL
    domain: tuple[str, ...] = DOMAIN
    regime: tuple[str, ...] = field(default_factory=regime_columns)
    lags: tuple[str, ...] = field(default_factory=lag_columns)
    rolling: tuple[str, ...] = field(default_factory=rolling_columns)
    train_only: tuple[str, ...] = TRAIN_ONLY
    features: tuple[str, ...] = FEATURES
    scaled: tuple[str, ...] = SCALED
    target: str = TARGET


def present(df, columns) -> list[str]:
    """The requested columns that exist, in the requested order."""
    have = set(df.columns)
    return [c for c in columns if c in have]
