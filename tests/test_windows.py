import numpy as np
import pandas as pd
import pytest
from conftest import same
from pyspark.sql import functions as F

from slotcast import (
    difference, fill_lags, first_rows, holdout_tail, lag_and_roll, lag_features, last_rows, plan_layout,
    rolling_features, row_index, sequence_windows, temporal_split, undifference, undifference_all,
)
from slotcast.operators import slices as slices_module, windows as windows_module
from slotcast.operators.slices import downsample
from slotcast.operators.timeline import Timeline

KW = dict(series=("series",), order=("ts", "id"))
ONE = dict(series=(), order=("ts", "id"))


def test_lag_positions(train, train_pd):
    got = lag_features(train).toPandas().sort_values("date").reset_index(drop=True)
    assert got["wind_lag_1"][5] == train_pd["wind"][4]
    assert got["load_lag_96"][100] == train_pd["load"][4]
    assert got["wind_lag_96"][:96].isna().all() and got["wind_lag_96"][96:].notna().all()
    assert "net_load_lag_1" not in got  # columns the frame lacks are skipped
    assert len([c for c in got if "_lag_" in c]) == 12


def test_fill_matches_pandas(train, train_pd):
    names = [f"{c}_lag_{k}" for c in ("wind", "solar", "load", "spread") for k in (1, 4, 96)]
    got = fill_lags(lag_features(train), names).toPandas().sort_values("date").reset_index(drop=True)
    assert got[names].notna().all().all()
    for c in ("wind", "spread"):
        for k in (1, 4, 96):
            assert np.allclose(got[f"{c}_lag_{k}"], train_pd[c].shift(k).ffill().bfill())


def test_rolling_matches_pandas(train, train_pd):
    got = rolling_features(train).toPandas().sort_values("date").reset_index(drop=True)
    for c in ("wind", "solar", "load", "spread"):
        for w in (4, 96):
            roll = train_pd[c].rolling(w, min_periods=1)
            assert np.allclose(got[f"{c}_rmean_{w}"], roll.mean())
            assert np.allclose(got[f"{c}_rstd_{w}"], roll.std().fillna(0), atol=1e-6)


@pytest.mark.parametrize("chunk_rows", [128, 700])
@pytest.mark.parametrize("kw", [KW, ONE], ids=["series", "single"])
def test_chunked_windows_equal_whole_series(uneven, chunk_rows, kw):
    layout = plan_layout(uneven, chunk_rows=chunk_rows, **kw)
    assert layout.chunked and not plan_layout(uneven, **kw).chunked
    cols = ("value", "holes", "late")
    same(lag_and_roll(uneven, cols, roll_base=cols, layout=layout), lag_and_roll(uneven, cols, roll_base=cols, **kw), ["id"])
    same(lag_features(uneven, cols, layout=layout), lag_features(uneven, cols, **kw), ["id"])
    same(row_index(uneven, layout=layout), row_index(uneven, **kw), ["id"])
    same(fill_lags(uneven, list(cols), layout=layout), fill_lags(uneven, list(cols), **kw), ["id"])


def test_one_pass_fill_equals_the_steps(uneven):
    for layout in (plan_layout(uneven, chunk_rows=200, **KW), plan_layout(uneven, **KW)):
        cols = ("value", "holes")
        names = [f"{c}_lag_{k}" for c in cols for k in (1, 4, 96)]
        steps = rolling_features(fill_lags(lag_features(uneven, cols, **KW), names, **KW), cols, **KW)
        same(lag_and_roll(uneven, cols, roll_base=cols, layout=layout), steps, ["id"])


def test_short_series_keeps_unreachable_lags_null(uneven):
    got = lag_and_roll(uneven, ("value",), roll_base=("value",), **KW).filter("series = 'short'").toPandas()
    assert len(got) == 60 and got["value_lag_96"].isna().all() and got["value_lag_4"].notna().all()


def test_burst_inside_one_minute_is_split(uneven):
    layout = plan_layout(uneven, chunk_rows=128, **KW)
    t = Timeline(uneven, layout, halo=96)
    largest = t.df.groupBy("series", "__chunk").count().agg(F.max("count")).first()[0]
    # a chunk, one bucket over, and its halo of whole buckets
    assert largest <= 128 + 128 + 96 + 128
    assert t.df.filter("__home").count() == uneven.count()


def test_equal_timestamps_are_split_by_the_next_order_column(spark):
    n = 1000
    df = spark.range(n).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), "id", (F.col("id") * 2.0).alias("value"))
    layout = plan_layout(df, chunk_rows=100, **ONE)
    assert len(layout.widths) == 2
    got = lag_features(df, ("value",), (1, 50), layout=layout).toPandas().sort_values("id")
    assert got["value_lag_1"].isna().sum() == 1 and (got["value_lag_50"].dropna() == got["value"][50:] - 100).all()


def test_null_series_key_is_a_series(spark):
    df = spark.createDataFrame(
        [(None if i % 2 else "a", (pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i)).to_pydatetime(), i) for i in range(400)],
        "series string, ts timestamp_ntz, id long")
    layout = plan_layout(df, ("series",), ("ts", "id"), 50)
    got = row_index(df, layout=layout).toPandas()
    assert len(got) == 400 and sorted(got["row_index"]) == sorted(list(range(200)) * 2)


def test_sequence_windows_exact_slices(train, train_pd):
    cols = ["wind", "solar"]
    got = sequence_windows(train, cols, "spread").orderBy("date").collect()
    assert len(got) == len(train_pd) - 95
    x = train_pd[cols].to_numpy(dtype=np.float32)
    for i in (0, 17, len(got) - 1):
        assert np.array_equal(np.array(got[i]["x"], dtype=np.float32), x[i:i + 96])
        assert got[i]["y"] == np.float32(train_pd["spread"][i + 95])


def test_sequence_too_short_raises(train):
    with pytest.raises(ValueError):
        sequence_windows(train.limit(5), ["wind"], "spread", length=10)


def test_chunked_sequences(uneven):
    a = sequence_windows(uneven, ("value",), "value", 20, layout=plan_layout(uneven, chunk_rows=150, **KW))
    b = sequence_windows(uneven, ("value",), "value", 20, **KW)
    flat = lambda d: d.select("series", "ts", "id", F.flatten("x").cast("string").alias("x"), "y")
    same(flat(a), flat(b), ["id"])


def test_differences_and_inverse(train, train_pd):
    d = difference(train.select("date", "spread"), "spread", 1, 2, "d2")
    got = d.toPandas().sort_values("date")["d2"].to_numpy()
    assert np.allclose(got[2:], np.diff(train_pd["spread"], 2)) and np.isnan(got[:2]).all()
    seasonal = difference(train.select("date", "spread"), "spread", 96)
    back = undifference(seasonal, "spread_diff_96", "spread", 96).toPandas().sort_values("date")
    assert np.allclose(back["restored"][96:], back["spread"][96:])


@pytest.mark.parametrize("d,D,m", [(1, 0, 5), (0, 1, 7), (2, 0, 3), (1, 1, 7), (1, 2, 4), (0, 0, 5)])
@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_differences_of_any_order_are_undone(spark, d, D, m, chunk_rows):
    rng = np.random.default_rng(d + 10 * D)
    rows = [(s, i, float(v)) for s, n in (("a", 400), ("b", 90), ("tiny", 2)) for i, v in enumerate(np.cumsum(rng.normal(0, 1, n)))]
    df = spark.createDataFrame(rows, "series string, id long, y double").repartition(3)
    out = df.withColumn("diff", F.col("y"))
    for lag in [1] * d + [m] * D:
        out = difference(out, "diff", lag, name="next", series=("series",), order=("id",)).drop("diff").withColumnRenamed("next", "diff")
    depth = d + m * D
    known = out.withColumn("level", F.when(F.col("id") < depth, F.col("y")))
    got = undifference_all(known, "diff", "level", d, D, m, series=("series",), order=("id",), chunk_rows=chunk_rows).toPandas()
    assert len(got) == len(rows) and np.allclose(got["restored"], got["y"])


def test_a_missing_difference_ends_what_depends_on_it(spark):
    rows = [(i, 1.0 if i < 3 else None, None if i < 3 or i == 7 else 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, level double, diff double")
    for chunk_rows in (None, 4):
        got = undifference_all(df, "diff", "level", 0, 1, 3, order=("id",), chunk_rows=chunk_rows).orderBy("id").toPandas()["restored"]
        assert got.isna().tolist() == [i in (7, 10) for i in range(12)] and got[11] == 4.0


def test_split_is_chronological_and_complete(train, train_pd):
    got = temporal_split(train, 0.2).toPandas().sort_values("date")
    cut = int(len(train_pd) * (1 - 0.2))
    assert list(got["role"]) == ["train"] * cut + ["val"] * (len(train_pd) - cut)


def test_slices(train, uneven, train_pd):
    roles = holdout_tail(train, 50, 100).toPandas().sort_values("date")
    assert list(roles["role"]) == ["fit"] * 100 + ["val"] * 50 and roles["date"].max() == train_pd["date"].max()
    assert downsample(train).count() == len(train_pd) // 4
    assert first_rows(uneven, 10, **KW).groupBy("series").count().filter("count = 10").count() == 2
    layout = plan_layout(uneven, chunk_rows=128, **KW)
    same(last_rows(uneven, 25, series=("series",), order=("ts", "id"), layout=layout), last_rows(uneven, 25, **KW), ["id"])
    assert last_rows(train, 7).agg(F.min("date")).first()[0] == train_pd["date"].iloc[-7].to_pydatetime()


@pytest.mark.parametrize("chunk_rows", [None, 300])
def test_blockwise_rolling_equals_sliding_frames(uneven, monkeypatch, chunk_rows):
    df = uneven.withColumn("flat", F.when(F.col("id") < 1500, F.lit(7.3)).otherwise(F.col("value")))
    cols = ("value", "holes", "late", "flat")
    layout = plan_layout(df, chunk_rows=chunk_rows, **KW)
    plain = rolling_features(df, cols, (4, 24, 96), layout=layout)
    monkeypatch.setattr(windows_module, "BLOCKWISE_FROM", 0)
    block = rolling_features(df, cols, (4, 24, 96), layout=layout)
    assert block.columns != [] and "__block" not in block.columns
    same(block, plain, ["id"])
    # a window of equal values has no deviation beyond the last bits
    assert block.filter("series = 'long' and id between 100 and 1400 and flat_rstd_96 > 1e-12").count() == 0


@pytest.mark.parametrize("order", [("ts", "id"), ("id",)])
def test_edge_rows_are_found_without_sorting_everything(uneven, order, monkeypatch):
    monkeypatch.setattr(slices_module, "SORTABLE", 10)
    ids = uneven.orderBy(*order).toPandas()["id"]
    for n in (1, 40, 2500, 5000):
        assert set(first_rows(uneven, n, order=order).toPandas()["id"]) == set(ids[:n])
        assert set(last_rows(uneven, n, order=order).toPandas()["id"]) == set(ids[-n:])


@pytest.mark.parametrize("chunk_rows", [None, 256])
def test_blockwise_windows_beside_filled_lags(uneven, monkeypatch, chunk_rows):
    cols, args = ("value", "holes"), dict(series=("series",), order=("ts", "id"), chunk_rows=chunk_rows)
    plain = lag_and_roll(uneven, cols, roll_base=cols, **args).toPandas().sort_values("id", ignore_index=True)
    monkeypatch.setattr(windows_module, "BLOCKWISE_FROM", 0)
    blocked = lag_and_roll(uneven, cols, roll_base=cols, **args).toPandas().sort_values("id", ignore_index=True)
    assert len(blocked) == uneven.count()
    pd.testing.assert_frame_equal(blocked[list(plain)], plain, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("chunk_rows", [None, 256])
def test_rolling_tasks_grow_with_the_rows(spark, uneven, monkeypatch, chunk_rows):
    many = spark.range(400).select(F.col("id").alias("s")).crossJoin(spark.range(20).select("id", (F.col("id") * 1.5).alias("value")))
    args = dict(windows=(4,), series=("s",), order=("id",))
    frames = {
        rolling_features: (many, dict(args)),
        lag_and_roll: (uneven.select("series", "ts", "id", "value"), dict(lag_base=("value",), lags=(1,), windows=(4,), series=("series",), order=("ts", "id"), chunk_rows=chunk_rows)),
    }
    for step, (df, kw) in frames.items():
        columns = {"columns" if step is rolling_features else "roll_base": ("value",)}
        monkeypatch.undo()
        plain = step(df, **columns, **kw)
        monkeypatch.setattr(windows_module, "ROLL_ROWS", 100)
        dealt = step(df, **columns, **kw)
        cut = f", {-(-df.count() // 100)}), REPARTITION_BY_NUM"
        assert cut not in plain._jdf.queryExecution().toString() and cut in dealt._jdf.queryExecution().toString()
        same(dealt, plain, ["s", "id"] if "s" in df.columns else ["id"])
