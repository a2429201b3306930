"""Train-only standardisation. Fitted statistics are one number pair per column, used as literals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import SCALED, TARGET, TARGET_SCALED, present


@dataclass(frozen=True)
class ScalerStats:
    """Mean and scale per column, fitted on the training table."""

    stats: dict[str, tuple[float, float]]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(c, m, s) for c, (m, s) in self.stats.items()], "column string, mean double, scale double"
        )

    @classmethod
    def from_frame(cls, frame: DataFrame) -> "ScalerStats":
        return cls({r["column"]: (r["mean"], r["scale"]) for r in frame.collect()})

    def __getitem__(self, column: str) -> tuple[float, float]:
        return self.stats[column]


def fit_scaler(df: DataFrame, columns=SCALED, target: str = TARGET) -> ScalerStats:
    """Mean and population deviation per column in one aggregate; a constant column gets scale 1."""
    wanted = present(df, dict.fromkeys([*columns, target]))
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in wanted], *[F.stddev_pop(c).alias(f"s_{c}") for c in wanted]
    ).first()
    return ScalerStats({c: (row[f"m_{c}"], row[f"s_{c}"] if row[f"s_{c}"] != 0 else 1.0) for c in wanted})


def scaler_table(df: DataFrame, columns=SCALED) -> DataFrame:
    """The fitted statistics as a table ``column, mean, scale``."""
    cols = present(df, columns)
    stats = fit_scaler(df.select(*cols), cols)
    return stats.to_frame(df.sparkSession)


def scale_train(df: DataFrame, stats: ScalerStats, columns=SCALED, target: str = TARGET) -> DataFrame:
    """Columns scaled in place, plus the scaled target beside the raw one."""
    out = _scaled(df, stats, columns)
    mean, scale = stats[target]
    return out.withColumn(f"{target}_scaled", (F.col(target) - mean) / scale)


def scale_test(df: DataFrame, stats: ScalerStats, columns=SCALED) -> DataFrame:
    """The columns a test table has, with the training statistics."""
    return _scaled(df, stats, columns)


def _scaled(df: DataFrame, stats: ScalerStats, columns) -> DataFrame:
    return df.withColumns({c: (F.col(c) - stats[c][0]) / stats[c][1] for c in present(df, columns)})


def inverse_scale(df: DataFrame, stats: ScalerStats, column: str, target: str = TARGET,
                  name: str | None = None) -> DataFrame:
    mean, scale = stats[target]
    return df.withColumn(name or column, F.col(column) * scale + mean)


def scaling_summary(scaled: DataFrame, columns=SCALED) -> DataFrame:
    """Mean and sample deviation per scaled column, to four decimals."""
    cols = present(scaled, columns)
    row = scaled.agg(
        *[F.round(F.avg(c), 4).alias(f"m_{c}") for c in cols],
        *[F.round(F.stddev_samp(c), 4).alias(f"s_{c}") for c in cols],
    ).first()
    return scaled.sparkSession.createDataFrame(
        [(c, row[f"m_{c}"], row[f"s_{c}"]) for c in cols], "column string, mean double, std double"
    )


def target_range(scaled: DataFrame, target: str = TARGET, scaled_target: str = TARGET_SCALED) -> DataFrame:
    return scaled.agg(
        F.min(target).alias("raw_min"), F.max(target).alias("raw_max"),
        F.min(scaled_target).alias("scaled_min"), F.max(scaled_target).alias("scaled_max"),
    )


def exog_stats(df: DataFrame, columns) -> ScalerStats:
    """Mean and *sample* deviation of regressors; a zero deviation becomes 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    return ScalerStats({c: (row[f"m_{c}"], row[f"s_{c}"] if row[f"s_{c}"] != 0 else 1.0) for c in columns})


def standardize_exog(df: DataFrame, stats: ScalerStats, columns, guard_infinite: bool = True) -> DataFrame:
    """Standardised regressors; what is missing (and, if guarded, infinite) becomes 0."""
    out = {}
    for c in columns:
        mean, scale = stats[c]
        z = (F.col(c) - F.lit(mean).cast("double")) / F.lit(scale).cast("double")
        if guard_infinite:
            z = F.when(F.abs(z) != float("inf"), z)
        out[c] = F.coalesce(z, F.lit(0.0))
    return df.withColumns(out)
