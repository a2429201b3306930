import numpy as np
import pandas as pd
import pytest
from conftest import same
from pyspark.sql import functions as F

from slotcast import (
    acf, autocorrelation, box_summary, correlation_matrix, data_summary, domain_features, exact_quantiles, first_gaps,
    histogram, interval_gaps, interval_report, median_fill, merge_imbalances, pacf, plan_layout, quantile_table,
    regular_grid, target_stats,
)

KW = dict(series=("series",), order=("ts", "id"))


def without(train, *rows):
    dates = [r["date"] for r in train.orderBy("date").collect()]
    return train.filter(~F.col("date").isin([dates[i] for i in rows]))


def test_gap_check(train, train_pd):
    assert interval_report(train).first().asDict() == {
        "total_intervals": len(train_pd) - 1, "correct_intervals": len(train_pd) - 1, "gap_count": 0, "is_sequential": True}
    broken = without(train, 5, 6, 50)
    report = interval_report(broken).first()
    assert (report["gap_count"], report["is_sequential"]) == (2, False)
    gaps = first_gaps(interval_gaps(broken)).collect()
    assert [(g["date"], g["gap_seconds"]) for g in gaps] == [
        (train_pd["date"][7].to_pydatetime(), 2700.0), (train_pd["date"][51].to_pydatetime(), 1800.0)]


def test_gap_check_chunked(uneven):
    layout = plan_layout(uneven, chunk_rows=128, **KW)
    kw = dict(series=("series",), ts="ts", ties=("id",))
    same(interval_gaps(uneven, layout=layout, **kw), interval_gaps(uneven, **kw), ["series", "ts"])


def test_regular_grid_and_median(train, train_pd):
    grid = regular_grid(without(train, 5, 6, 50)).orderBy("date").toPandas()
    assert len(grid) == len(train_pd) and list(np.flatnonzero(grid["spread"].isna())) == [5, 6, 50]
    filled = median_fill(regular_grid(without(train, 5, 6, 50))).orderBy("date").toPandas()["spread"]
    assert filled[5] == pytest.approx(train_pd["spread"].drop([5, 6, 50]).median()) and filled.notna().all()


def test_repeated_dates_are_an_error(train):
    with pytest.raises(ValueError):
        regular_grid(train.union(train.limit(1)))


def test_merge_fans_out_and_keeps_unmatched(spark, train, imbalances):
    some = imbalances.limit(10)
    merged = merge_imbalances(train, some.union(some))
    assert merged.count() == train.count() + 10
    assert merged.filter("imbalances IS NULL").count() == train.count() - 10


def test_data_summary_counts_missing(train, imbalances):
    rows = data_summary({"train": merge_imbalances(train, imbalances.limit(100))}).collect()
    missing = {r["column_name"]: r["missing"] for r in rows}
    assert missing["imbalances"] == train.count() - 100 and missing["wind"] == 0 and rows[0]["columns"] == 6


def test_target_stats_match_pandas(train, train_pd):
    s, got = train_pd["spread"], target_stats(train).first()
    q1, med, q3 = s.quantile([0.25, 0.5, 0.75])
    want = dict(count=len(s), mean=s.mean(), std=s.std(), min=s.min(), q1=q1, median=med, q3=q3, max=s.max(),
                skewness=s.skew(), kurtosis=s.kurtosis(), iqr=q3 - q1, pct_positive=(s > 0).mean() * 100,
                pct_negative=(s < 0).mean() * 100, pct_zero=(s == 0).mean() * 100)
    for name, value in want.items():
        assert got[name] == pytest.approx(value), name


def test_quantiles_by_narrowing_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.standard_cauchy(4000) * 1e4, np.zeros(3000), [1e300, -1e300], rng.normal(0, 1e-6, 2000)])
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = exact_quantiles(df, "v", probs, small=50, bins=8)
    assert np.allclose(got, np.quantile(values, probs), rtol=1e-12, atol=0)
    assert exact_quantiles(df.filter("false"), "v", [0.5]) == [None]


def test_quantiles_of_many_large_series_at_once(spark):
    rng = np.random.default_rng(13)
    many = {f"s{i}": rng.standard_cauchy(rng.integers(120, 900)) * 10.0 ** rng.integers(-5, 9) for i in range(12)}
    many |= {"flat": np.full(300, 2.5), "two": np.array([1.0, 2.0]), "ties": np.repeat([1.0, 7.0, 9.0], 200), None: rng.normal(0, 1, 500)}
    rows = [(k, float(v)) for k, vs in many.items() for v in vs] + [("two", None), ("empty", None)]
    df = spark.createDataFrame(rows, "series string, value double").repartition(5)
    probs, names = [0.0, 0.1, 0.25, 0.5, 0.993, 1.0], [f"q{i}" for i in range(6)]
    for small, bins in ((50, 8), (1, 3)):
        got = {r["series"]: list(r)[1:] for r in quantile_table(df, "value", probs, names, ("series",), small, bins).collect()}
        assert got.pop("empty") == [None] * 6 and set(got) == set(many)
        for k, vs in many.items():
            assert np.allclose(got[k], np.quantile(vs, probs), rtol=1e-12), k


def test_quantiles_of_a_hot_series(uneven):
    a = quantile_table(uneven, "value", [0.25, 0.5], ["q1", "q2"], ("series",), small=100)
    b = quantile_table(uneven, "value", [0.25, 0.5], ["q1", "q2"], ("series",))
    same(a, b, ["series"])


def test_autocorrelation_matches_pandas(train, train_pd, uneven):
    got = {r["lag"]: r["r"] for r in autocorrelation(train).collect()}
    for lag, r in got.items():
        assert r == pytest.approx(train_pd["spread"].autocorr(lag)), lag
    layout = plan_layout(uneven, chunk_rows=256, **KW)
    same(autocorrelation(uneven, "value", (1, 96), layout=layout, **KW), autocorrelation(uneven, "value", (1, 96), **KW), ["series", "lag"])


def biased(y, k):
    c = y - y.mean()
    return (c[k:] * c[:len(c) - k]).sum() / (c * c).sum()


def test_acf_on_the_last_rows(train, train_pd, uneven):
    y = train_pd["spread"].to_numpy()[-300:]
    got = {r["lag"]: r["r"] for r in acf(train, nlags=12, last_rows=300).collect()}
    for k in range(13):
        assert got[k] == pytest.approx(biased(y, k))
    layout = plan_layout(uneven, chunk_rows=256, **KW)
    same(acf(uneven, "value", 5, 500, layout=layout, **KW), acf(uneven, "value", 5, 500, **KW), ["series", "lag"])


@pytest.mark.parametrize("method", ["ywadjusted", "ywm"])
def test_pacf_solves_yule_walker(train, train_pd, method):
    y = train_pd["spread"].to_numpy()
    c, n = y - y.mean(), len(y)
    gamma = np.array([(c[k:] * c[:n - k]).sum() / (n - k if method == "ywadjusted" else n) for k in range(9)])
    got = {r["lag"]: r["r"] for r in pacf(train, nlags=8, method=method, last_rows=None).collect()}
    for k in range(1, 9):
        toeplitz = np.array([[gamma[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(toeplitz, gamma[1:k + 1])[-1])


def test_correlation_matrix_is_pairwise_complete(uneven):
    got = correlation_matrix(uneven, ["value", "holes", "id", "late", "missing"]).toPandas().set_index(["x", "y"])["r"]
    want = uneven.select("value", "holes", "id", "late").toPandas().astype(float).corr()
    for a in want:
        for b in want:
            assert got[(a, b)] == pytest.approx(want.loc[a, b])


def test_correlation_of_a_constant_is_null(train):
    got = correlation_matrix(domain_features(train).withColumn("one", F.lit(3.7)), ["one", "wind"]).toPandas().set_index(["x", "y"])["r"]
    assert np.isnan(got[("one", "wind")]) and got[("wind", "wind")] == pytest.approx(1)


def test_histogram_matches_numpy(train, train_pd):
    got = histogram(train, bins=20).orderBy("bin").toPandas()
    counts, edges = np.histogram(train_pd["spread"], bins=20)
    assert list(got["count"]) == list(counts) and np.allclose(got["left"], edges[:-1]) and np.allclose(got["right"], edges[1:])


def test_box_summary(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0, -50.0]
    got = box_summary(spark.createDataFrame([(v,) for v in values], "spread double")).first()
    q1, med, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (got["q1"], got["median"], got["q3"]) == (q1, med, q3)
    assert (got["whisker_low"], got["whisker_high"], got["outliers"]) == (1.0, 6.0, 2)
