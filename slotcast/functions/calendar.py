"""Calendar parts, cyclical encodings and Fourier terms. All plain projections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import DAILY_HARMONICS, DATE, SLOTS_PER_DAY, SLOTS_PER_WEEK, WEEKLY_HARMONICS

TAU = 2 * math.pi


def naive(value):
    """A naive datetime as a literal; passed as text, since a datetime literal is read in the Python process's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def slot_of_day(ts: Column) -> Column:
    """15-minute slot within the day, 0..95."""
    return F.hour(ts) * 4 + F.floor(F.minute(ts) / 15).cast("int")


def _wave(fn, position: Column, period: int, harmonic: int = 1) -> Column:
    return fn(F.lit(TAU * harmonic) * position / F.lit(float(period)))


def temporal_parts(df: DataFrame, ts: str = DATE) -> DataFrame:
    t = F.col(ts)
    dow = F.weekday(t)  # Monday is 0
    return df.withColumns({
        "hour": F.hour(t),
        "minute": F.minute(t),
        "day_of_week": dow,
        "month": F.month(t),
        "day_of_year": F.dayofyear(t),
        "quarter": F.quarter(t),
        "interval_of_day": slot_of_day(t),
        "is_weekend": (dow >= 5).cast("int"),
    })


def temporal_cyclical(df: DataFrame, ts: str = DATE) -> DataFrame:
    """Each periodic part as a point on the unit circle."""
    t = F.col(ts)
    cycles = {
        "hour": (F.hour(t), 24),
        "month": (F.month(t) - 1, 12),
        "dow": (F.weekday(t), 7),
        "interval": (slot_of_day(t), SLOTS_PER_DAY),
    }
    out = {}
    for name, (position, period) in cycles.items():
        out[f"{name}_sin"] = _wave(F.sin, position, period)
        out[f"{name}_cos"] = _wave(F.cos, position, period)
    return df.withColumns(out)


def temporal_features(df: DataFrame, ts: str = DATE) -> DataFrame:
    return temporal_cyclical(temporal_parts(df, ts), ts)


def fourier_arimax(
    df: DataFrame, ts: str = DATE, daily: int = DAILY_HARMONICS, weekly: int = WEEKLY_HARMONICS
) -> DataFrame:
    """Hour, weekday, month; daily waves on the hour, weekly waves on the slot of the week."""
    t = F.col(ts)
    week = F.weekday(t) * SLOTS_PER_DAY + slot_of_day(t)
    out = {"hour": F.hour(t), "dow": F.weekday(t), "month": F.month(t)}
    for k in range(1, daily + 1):
        out[f"sin_daily_{k}"] = _wave(F.sin, F.hour(t), 24, k)
        out[f"cos_daily_{k}"] = _wave(F.cos, F.hour(t), 24, k)
    for k in range(1, weekly + 1):
        out[f"sin_weekly_{k}"] = _wave(F.sin, week, SLOTS_PER_WEEK, k)
        out[f"cos_weekly_{k}"] = _wave(F.cos, week, SLOTS_PER_WEEK, k)
    return df.withColumns(out)


def fourier_sarima(
    df: DataFrame, ts: str = DATE, daily: int = DAILY_HARMONICS, weekly: int = WEEKLY_HARMONICS
) -> DataFrame:
    """Daily waves on the slot of the day, weekend flag and the three domain columns.

    The ratio divides by the load clipped at 1 from below; a missing load stays
    missing (``greatest`` alone would skip it and divide by 1).
    """
    t = F.col(ts)
    slot = slot_of_day(t)
    week = F.weekday(t) * SLOTS_PER_DAY + slot
    load = F.col("load")
    renewable = F.col("wind") + F.col("solar")
    out = {
        "hour": F.hour(t),
        "dow": F.weekday(t),
        "month": F.month(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
    }
    for k in range(1, daily + 1):
        out[f"sin_d{k}"] = _wave(F.sin, slot, SLOTS_PER_DAY, k)
        out[f"cos_d{k}"] = _wave(F.cos, slot, SLOTS_PER_DAY, k)
    for k in range(1, weekly + 1):
        out[f"sin_w{k}"] = _wave(F.sin, week, SLOTS_PER_WEEK, k)
        out[f"cos_w{k}"] = _wave(F.cos, week, SLOTS_PER_WEEK, k)
    out["net_load"] = load - F.col("wind") - F.col("solar")
    out["renewable_ratio"] = renewable / F.when(load.isNotNull(), F.greatest(load, F.lit(1.0)))
    out["total_renewable"] = renewable
    return df.withColumns(out)


def arimax_exog(daily: int = DAILY_HARMONICS, weekly: int = WEEKLY_HARMONICS) -> list[str]:
    waves = [f"{w}_daily_{k}" for k in range(1, daily + 1) for w in ("sin", "cos")]
    waves += [f"{w}_weekly_{k}" for k in range(1, weekly + 1) for w in ("sin", "cos")]
    return ["wind", "solar", "load", *waves, "hour", "dow", "month"]


def sarima_exog(daily: int = DAILY_HARMONICS, weekly: int = WEEKLY_HARMONICS) -> list[str]:
    waves = [f"{w}_d{k}" for k in range(1, daily + 1) for w in ("sin", "cos")]
    waves += [f"{w}_w{k}" for k in range(1, weekly + 1) for w in ("sin", "cos")]
    return [
        "wind", "solar", "load", *waves, "hour", "dow", "month", "is_weekend",
        "net_load", "renewable_ratio", "total_renewable",
    ]
