"""From forecasts to the probability of a positive outcome."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.domain import is_positive
from .evaluate import probability_summary

FREE = 1e6       # inverse penalty of the calibrator: practically none
SCRIPT_C = 1.0   # inverse penalty the classical-model runs use


@dataclass(frozen=True)
class Calibrator:
    coef: float | None = None
    intercept: float | None = None
    directional_accuracy: float | None = None

    @property
    def is_fitted(self) -> bool:
        return self.coef is not None

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.coef, self.intercept, self.directional_accuracy)],
            "coef double, intercept double, directional_accuracy double",
        )

    @classmethod
    def from_frame(cls, frame: DataFrame) -> "Calibrator":
        return cls(**frame.first().asDict())


def calibrate_fit(df: DataFrame, predicted: str = "predicted", actual: str = "actual", c: float = FREE,
                  max_iter: int = 100) -> Calibrator:
    """Logistic regression of the outcome's sign on the forecast, with an L2 penalty of 1 / c on the slope.

    With two coefficients Newton's method needs about six passes, each one a
    plain aggregate of six sums, where a gradient method would need dozens.
    """
    hit = (is_positive(F.col(actual)) == is_positive(F.col(predicted))).cast("double")
    data = df.filter(F.col(predicted).isNotNull() & F.col(actual).isNotNull()).select(
        F.col(predicted).cast("double").alias("x"), is_positive(F.col(actual)).cast("double").alias("y"), hit.alias("hit")
    )
    data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _newton(data, c, max_iter)
    finally:
        data.unpersist()


def _newton(data: DataFrame, c: float, max_iter: int) -> Calibrator:
    n, positives, spread, accuracy = data.agg(F.count("x"), F.sum("y"), F.stddev_pop("x"), F.avg("hit")).first()
    if not n or positives in (0, n):
        raise ValueError("calibration needs outcomes on both sides of zero")
    # the fit runs on x / spread for conditioning; the penalty moves along with the slope
    unit = spread or 1.0
    penalty = 1.0 / (c * unit * unit)
    rate = positives / n

    def sums(a, b):
        z = F.lit(a) + F.col("x") / unit * b
        p = 1 / (1 + F.exp(-z))
        # log(1 + e^z) without overflow on either side
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("y") * z
        u, w = F.col("x") / unit, p * (1 - p)
        row = data.agg(
            F.sum(loss), F.sum(p - F.col("y")), F.sum((p - F.col("y")) * u), F.sum(w), F.sum(w * u), F.sum(w * u * u)
        ).first()
        return row[0] + penalty * b * b / 2, np.array([row[1], row[2] + penalty * b]), np.array(
            [[row[3], row[4]], [row[4], row[5] + penalty]]
        )

    at = np.array([math.log(rate / (1 - rate)), 0.0])
    value, gradient, hessian = sums(*map(float, at))
    for _ in range(max_iter):
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        if np.abs(step).max() < 1e-9 * (1 + np.abs(at).max()):
            break
        size = 1.0
        while True:
            trial = at - size * step
            new = sums(*map(float, trial))
            if new[0] <= value + 1e-12 * abs(value) or size < 1e-6:
                break
            size /= 2
        at, (value, gradient, hessian) = trial, new
    return Calibrator(float(at[1]) / unit, float(at[0]), accuracy)


def calibrate_apply(df: DataFrame, calibrator: Calibrator, predicted: str = "predicted",
                    name: str = "probability") -> DataFrame:
    if not calibrator.is_fitted:
        raise RuntimeError("the calibrator must be fitted before it is applied")
    z = F.col(predicted) * calibrator.coef + calibrator.intercept
    return df.withColumn(name, 1 / (1 + F.exp(-z)))


def sigmoid_temperature(df: DataFrame, predicted: str = "predicted", temperature: float | None = None,
                        name: str = "probability") -> DataFrame:
    """Model-free probability: sigmoid of the forecast over a temperature (its population deviation by default)."""
    if temperature is None:
        temperature = max(df.agg(F.stddev_pop(predicted)).first()[0] or 0.0, 1e-8)
    return df.withColumn(name, 1 / (1 + F.exp(-F.col(predicted) / F.lit(float(temperature)))))


def calibration_summary(df: DataFrame, calibrator: Calibrator, probability: str = "probability") -> DataFrame:
    """Coefficients, accuracy and the probabilities' range and mean in one row."""
    return probability_summary(df, probability, forecast=None).select(
        F.lit(calibrator.coef).alias("coef"), F.lit(calibrator.intercept).alias("intercept"),
        F.lit(calibrator.directional_accuracy).alias("directional_accuracy"), "p_min", "p_max", "p_mean",
    )
