import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast import (
    domain_features, fourier_arimax, fourier_sarima, nan_to_null, sign_label, temporal_features, temporal_parts,
)
from slotcast.functions.calendar import arimax_exog, sarima_exog
from slotcast.schema import FEATURES, SCALED, TEMPORAL, TEMPORAL_RAW


def test_calendar_parts_match_pandas(train, train_pd):
    got = temporal_parts(train).toPandas().sort_values("date").reset_index(drop=True)
    d = train_pd["date"].dt
    assert (got["hour"] == d.hour).all() and (got["minute"] == d.minute).all()
    assert (got["day_of_week"] == d.dayofweek).all() and (got["month"] == d.month).all()
    assert (got["day_of_year"] == d.dayofyear).all() and (got["quarter"] == d.quarter).all()
    assert (got["interval_of_day"] == d.hour * 4 + d.minute // 15).all()
    assert (got["is_weekend"] == (d.dayofweek >= 5).astype(int)).all()


def test_cyclical_columns_stay_on_the_unit_circle(train):
    got = temporal_features(train).toPandas()
    assert set(TEMPORAL) | set(TEMPORAL_RAW) <= set(got.columns)
    for name in ("hour", "month", "dow", "interval"):
        r = got[f"{name}_sin"] ** 2 + got[f"{name}_cos"] ** 2
        assert np.allclose(r, 1)
    assert got.notna().all().all() and got["interval_of_day"].between(0, 95).all()


def test_calendar_ignores_the_session_zone(spark, train):
    here = [r["hour"] for r in temporal_parts(train).orderBy("date").limit(20).collect()]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        there = [r["hour"] for r in temporal_parts(train).orderBy("date").limit(20).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert here == there


def test_domain_columns(train, train_pd):
    got = domain_features(train).toPandas().sort_values("date").reset_index(drop=True)
    p = train_pd
    assert np.allclose(got["net_load"], p["load"] - p["wind"] - p["solar"])
    assert np.allclose(got["renewable_ratio"], (p["wind"] + p["solar"]) / p["load"])
    assert np.allclose(got["wind_solar_ratio"], p["wind"] / (p["solar"] + 1))
    assert np.allclose(got["total_renewable"], p["wind"] + p["solar"])


def test_domain_edge_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (1.0, -1.0, 5.0), (None, 2.0, 5.0)], "wind double, solar double, load double")
    rows = domain_features(df).collect()
    assert rows[0]["renewable_ratio"] == 0.0
    assert rows[1]["wind_solar_ratio"] is None
    assert rows[2]["renewable_ratio"] == 0.0 and rows[2]["net_load"] is None


def test_fourier_variants(train):
    a, s = fourier_arimax(train), fourier_sarima(train)
    assert len(arimax_exog()) == 16 and set(arimax_exog()) <= set(a.columns)
    assert len(sarima_exog()) == 20 and set(sarima_exog()) <= set(s.columns)
    quarter_past = a.filter("minute(date) = 15 and hour(date) = 6").first()
    assert quarter_past["sin_daily_1"] == pytest.approx(1.0)  # the hour alone counts
    quarter_past = s.filter("minute(date) = 15 and hour(date) = 6").first()
    assert quarter_past["sin_d1"] == pytest.approx(np.sin(2 * np.pi * 25 / 96))


def test_sarima_ratio_clips_small_loads(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5), (1.0, 2.0, None)], "wind double, solar double, load double").withColumn(
        "date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = fourier_sarima(df).collect()
    assert rows[0]["renewable_ratio"] == 3.0 and rows[1]["renewable_ratio"] is None


def test_nan_becomes_null_and_signs(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, -1.0), (0.0, 0.0)], "actual double, predicted double")
    rows = sign_label(nan_to_null(df)).collect()
    assert rows[0]["actual"] is None
    assert [(r["actual_positive"], r["predicted_positive"], r["sign_match"]) for r in rows] == [(0, 1, 0), (1, 0, 0), (0, 0, 1)]


def test_column_groups_have_the_documented_sizes():
    assert len(FEATURES) == 45 and len(set(FEATURES)) == 45
    assert len(SCALED) == 39 and len(set(SCALED)) == 39
