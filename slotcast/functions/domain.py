"""Energy-market columns derived from wind, solar and load, and sign helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def domain_features(df: DataFrame) -> DataFrame:
    wind, solar, load = F.col("wind"), F.col("solar"), F.col("load")
    return df.withColumns({
        "net_load": load - wind - solar,
        # a zero load has no share; the missing share then counts as 0
        "renewable_ratio": F.coalesce((wind + solar) / F.nullif(load, F.lit(0.0)), F.lit(0.0)),
        # try_divide: solar = -1 gives NULL rather than an ANSI error
        "wind_solar_ratio": F.try_divide(wind, solar + 1),
        "total_renewable": wind + solar,
    })


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks missing data at the edge; inside, only NULL does, since aggregates skip it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def is_positive(value: Column) -> Column:
    """1 when above zero, else 0; missing counts as not positive, as a comparison with NaN does."""
    return F.coalesce(value > 0, F.lit(False)).cast("int")


def sign_label(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    a, p = is_positive(F.col(actual)), is_positive(F.col(predicted))
    return df.withColumns({
        "actual_positive": a, "predicted_positive": p, "sign_match": (a == p).cast("int"),
    })
