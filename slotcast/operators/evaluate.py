"""Error metrics, directional accuracy and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.domain import is_positive


def _grouped(df, by):
    return df.groupBy(*by) if by else df


def error_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by=()) -> DataFrame:
    """MAE, RMSE and R2 over rows that have both values; R2 is 0 when the actual values do not vary."""
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    e = F.col(predicted) - F.col(actual)
    sums = _grouped(both, by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("__mse"),
        F.var_pop(actual).alias("__var"),
    )
    r2 = F.when(F.col("__var") > 0, 1 - F.col("__mse") / F.nullif(F.col("__var"), F.lit(0.0))).otherwise(F.lit(0.0))
    return sums.select(*by, "n", "mae", F.sqrt("__mse").alias("rmse"), r2.alias("r2"))


def directional_accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by=()) -> DataFrame:
    """Share of rows where prediction and outcome are both above zero or both not."""
    hit = (is_positive(F.col(actual)) == is_positive(F.col(predicted))).cast("double")
    return _grouped(df, by).agg(F.avg(hit).alias("directional_accuracy"))


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold metrics."""
    out = []
    for m in ("mae", "rmse", "r2"):
        out += [F.avg(f"val_{m}").alias(f"mean_{m}"), F.stddev_pop(f"val_{m}").alias(f"std_{m}")]
    return folds.agg(F.count(F.lit(1)).alias("folds"), *out)


def probability_summary(df: DataFrame, probability: str = "probability", forecast: str | None = "predicted",
                        by=()) -> DataFrame:
    out = [F.min(probability).alias("p_min"), F.max(probability).alias("p_max"), F.avg(probability).alias("p_mean")]
    if forecast:
        out += [F.min(forecast).alias("forecast_min"), F.max(forecast).alias("forecast_max"),
                F.avg(forecast).alias("forecast_mean")]
    return _grouped(df, by).agg(*out)


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.withColumn("residual", F.col(predicted) - F.col(actual))


def prediction_bounds(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Shared axis limits of the predicted-against-actual view, with the residuals' MAE and RMSE."""
    e = F.col(predicted) - F.col(actual)
    return df.agg(
        F.least(F.min(actual), F.min(predicted)).alias("low"), F.greatest(F.max(actual), F.max(predicted)).alias("high"),
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
    )


def fold_bars(folds: DataFrame) -> DataFrame:
    """Fold metrics in long form with the mean over folds beside each (one row per fold and metric)."""
    long = folds.select("fold_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"val_{m}").alias("value")) for m in ("mae", "rmse", "r2")
    ])))
    means = long.groupBy("metric").agg(F.avg("value").alias("mean"))
    return long.join(means, "metric").select("fold_id", "metric", "value", "mean")
