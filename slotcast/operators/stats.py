"""Distribution and dependence of the target."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..schema import ACF_LAGS, LAG_LABELS, LAGS, TARGET, present
from .quantiles import SMALL, exact_quantiles, quantile_table
from .timeline import Layout, open_timeline


def target_stats(df: DataFrame, column: str = TARGET, series=(), small: int = SMALL) -> DataFrame:
    """Count, moments (bias-corrected), quartiles and sign shares. Shares are of all rows, missing included.

    Quartiles of more than ``small`` rows are found by narrowing.
    """
    x = F.col(column).cast("double")
    base = (df.groupBy(*series) if series else df).agg(
        F.count(F.lit(1)).alias("count"), F.count(x).alias("__n"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.skewness(x).alias("__g1"), F.kurtosis(x).alias("__g2"),
        F.count_if(x > 0).alias("__pos"), F.count_if(x < 0).alias("__neg"), F.count_if(x == 0).alias("__zero"),
    )
    probs, names = [0.25, 0.5, 0.75], ["q1", "median", "q3"]
    if series:
        q = quantile_table(df, column, probs, names, series, small)
        q = q.select(*[F.col(k).alias(f"__k_{k}") for k in series], *names)
        cond = None
        for k in series:
            eq = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
            cond = eq if cond is None else cond & eq
        base = base.join(q, cond)
    else:
        got = exact_quantiles(df, column, probs, small)
        base = base.withColumns({n: F.lit(v).cast("double") for n, v in zip(names, got)})
    n = F.col("__n").cast("double")
    skew = F.when(n > 2, F.col("__g1") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurt = F.when(n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * F.col("__g2") + 6))
    share = {s: F.try_divide(F.col(f"__{s}") * 100.0, F.col("count")) for s in ("pos", "neg", "zero")}
    return base.select(
        *series, "count", "mean", "std", "min", "q1", "median", "q3", "max",
        skew.alias("skewness"), kurt.alias("kurtosis"), (F.col("q3") - F.col("q1")).alias("iqr"),
        share["pos"].alias("pct_positive"), share["neg"].alias("pct_negative"), share["zero"].alias("pct_zero"),
    )


def _long(row: DataFrame, series, pairs, key: str, value: str) -> DataFrame:
    """One wide row per series as (key, value) rows."""
    return row.select(*series, F.inline(F.array(*[
        F.struct(F.lit(k).alias(key), v.alias(value)) for k, v in pairs
    ])))


def autocorrelation(df: DataFrame, column: str = TARGET, lags=ACF_LAGS, series=(), order=("date",),
                    layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Pearson correlation of the column with itself k rows back, over the overlapping pairs."""
    t = open_timeline(df.select(*series, *order, column), series, order, halo=max(lags), layout=layout,
                      chunk_rows=chunk_rows)
    lagged = t.close(t.df.withColumns({f"lag{k}": F.lag(column, k).over(t.window) for k in lags}))
    row = (lagged.groupBy(*series) if series else lagged).agg(
        *[F.corr(column, f"lag{k}").alias(f"r{k}") for k in lags]
    )
    return _long(row, series, [(k, F.col(f"r{k}")) for k in lags], "lag", "r")


def acf_bars(r: DataFrame) -> DataFrame:
    """Autocorrelations with the lags chosen as features marked and labelled."""
    label = F.lit(None).cast("string")
    for k, text in LAG_LABELS.items():
        label = F.when(F.col("lag") == k, text).otherwise(label)
    return r.withColumns({"selected": F.col("lag").isin(*LAG_LABELS), "label": label}).orderBy("lag")


def lag_correlation(df: DataFrame, column: str = TARGET, lags=LAGS) -> DataFrame:
    """Correlation of the column with its (already filled) lag columns."""
    cols = present(df, [f"{column}_lag_{k}" for k in lags])
    row = df.agg(*[F.corr(column, c).alias(c) for c in cols])
    return _long(row, (), [(int(c.rsplit("_", 1)[1]), F.col(c)) for c in cols], "lag", "r")


def autocovariance_sums(df: DataFrame, column: str, nlags: int, last_rows: int | None, series, order,
                        layout, chunk_rows) -> DataFrame:
    """``series..., rows, lag, s``: sums of (y_t - mean)(y_{t-k} - mean) over the last rows, k = 0..nlags.

    The mean need not be known beforehand: the sum follows from plain sums of
    y_t y_{t-k}, y_t and y_{t-k}. A shift near the mean keeps those small.
    """
    shift = df.agg(F.avg(column)).first()[0] or 0.0
    t = open_timeline(df.select(*series, *order, (F.col(column).cast("double") - shift).alias("__y")),
                      series, order, halo=nlags, layout=layout, chunk_rows=chunk_rows)
    begin = F.lit(0).cast("long") if last_rows is None else F.greatest(t.total() - last_rows, F.lit(0))
    # helper names lose their prefix so that closing the timeline keeps them
    step = t.close(t.df.withColumns({
        "y": F.col("__y"), "at": t.position(), "begin": begin,
        **{f"y{k}": F.lag("__y", k).over(t.window) for k in range(1, nlags + 1)},
    })).filter(F.col("at") >= F.col("begin"))
    aggs = [F.count("y").alias("rows"), F.sum("y").alias("a0"), F.sum(F.col("y") * F.col("y")).alias("p0")]
    for k in range(1, nlags + 1):
        inside = F.col("at") - k >= F.col("begin")
        aggs += [
            F.sum(F.when(inside, F.col("y") * F.col(f"y{k}"))).alias(f"p{k}"),
            F.sum(F.when(inside, F.col("y") + F.col(f"y{k}"))).alias(f"a{k}"),
        ]
    row = (step.groupBy(*series) if series else step).agg(*aggs)
    n = F.col("rows").cast("double")
    mean = F.try_divide(F.col("a0"), n)
    pairs = [(0, F.col("p0") - F.col("a0") * mean)]
    for k in range(1, nlags + 1):
        pairs.append((k, F.coalesce(F.col(f"p{k}") - mean * F.col(f"a{k}") + (n - k) * mean * mean, F.lit(0.0))))
    return _long(row, [*series, "rows"], pairs, "lag", "s")


def acf(df: DataFrame, column: str = TARGET, nlags: int = 10, last_rows: int | None = None,
        series=(), order=("date",), layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Autocorrelation with the global mean and the full length as divisor (the biased estimate)."""
    s = autocovariance_sums(df, column, nlags, last_rows, series, order, layout, chunk_rows)
    # every lag's row carries its own sum; lag 0 is shared through the group's small array
    keys = [*series]
    packed = (s.groupBy(*keys) if keys else s).agg(
        F.max(F.when(F.col("lag") == 0, F.col("s"))).alias("s0"),
        F.array_sort(F.collect_list(F.struct("lag", "s"))).alias("sums"),
    )
    return packed.select(*keys, "s0", F.inline("sums")).select(
        *keys, "lag", F.try_divide(F.col("s"), F.col("s0")).alias("r")
    )


def pacf(df: DataFrame, column: str = TARGET, nlags: int = 10, method: str = "ywadjusted",
         last_rows: int | None = None, series=(), order=("date",), layout: Layout | None = None,
         chunk_rows: int | None = None) -> DataFrame:
    """Partial autocorrelation by Yule-Walker: the sums come from Spark, the recursion runs on nlags numbers.

    ``ywadjusted`` divides the k-th sum by n - k, ``ywm`` by n.
    """
    if method not in ("ywadjusted", "ywm"):
        raise ValueError(f"unknown method {method!r}")
    s = autocovariance_sums(df, column, nlags, last_rows, series, order, layout, chunk_rows)
    keys = [*series] or ["__all"]
    s = s if series else s.withColumn("__all", F.lit(0))
    kinds = {f.name: f.dataType.simpleString() for f in s.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["lag int", "r double"])

    def recurse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        n = float(pdf["rows"].iloc[0])
        k = pdf["lag"].to_numpy()
        gamma = pdf["s"].to_numpy() / (n - k if method == "ywadjusted" else n)
        out = pd.DataFrame({"lag": k, "r": levinson(gamma)})
        for name in keys:
            out[name] = pdf[name].iloc[0]
        return out[[*keys, "lag", "r"]]

    return s.groupBy(*keys).applyInPandas(recurse, schema).drop("__all")


def levinson(gamma: np.ndarray) -> np.ndarray:
    """Last coefficient of the best linear predictor of each order, from autocovariances."""
    out = np.full(len(gamma), np.nan)
    out[0] = 1.0
    phi, error = np.zeros(0), gamma[0]
    for k in range(1, len(gamma)):
        if not error:
            break
        reflection = (gamma[k] - phi @ gamma[k - 1:0:-1]) / error
        phi = np.append(phi - reflection * phi[::-1], reflection)
        error *= 1 - reflection ** 2
        out[k] = reflection
    return out


def histogram(df: DataFrame, column: str = TARGET, bins: int = 200) -> DataFrame:
    """Equal-width bins from min to max with the last one closed; empty bins are listed with count 0."""
    x = F.col(column).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    spark = df.sparkSession
    ids = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return ids.limit(0).withColumns({"left": F.lit(0.0), "right": F.lit(0.0), "count": F.lit(0).cast("long")})
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    place = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # both sides have at most `bins` rows
    return ids.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
    )


def center_marks(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Mean and median, the two marks of the histogram."""
    (median,) = exact_quantiles(df, column, [0.5])
    return df.agg(F.avg(column).alias("mean")).withColumn("median", F.lit(median).cast("double"))


def box_summary(df: DataFrame, column: str = TARGET, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the extreme values inside the fences, and the number of points beyond."""
    q1, med, q3 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    x = F.col(column).cast("double")
    if q1 is None:  # no value at all
        return df.agg(*[F.lit(None).cast("double").alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], F.count(x).alias("outliers"))
    low, high = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
    inside = x.between(F.lit(low), F.lit(high))
    # without a value between fence and quartile the whisker ends at the box
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
        F.least(F.coalesce(F.min(F.when(inside, x)), F.lit(q1)), F.lit(q1)).alias("whisker_low"),
        F.greatest(F.coalesce(F.max(F.when(inside, x)), F.lit(q3)), F.lit(q3)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
