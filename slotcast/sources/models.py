"""Fitted models as tables: classical models of any number of series, and the ridge model.

A saved model is two versioned tables: ``fits`` holds the coefficients (per series), ``model`` one row that says what they
belong to and which version of ``fits`` is meant. The row is written last, so a job that fails on the way, or a reader at
work during a save, keeps the model before, coefficients and description together.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.autoreg import ArxModel, ArxSpec
from ..operators.css import CssModel
from ..operators.linear import LinearModel
from .sinks import read_versioned, write_versioned

Model = ArxModel | CssModel | LinearModel
CLASSICAL = {"regression": ArxModel, "css": CssModel}


def save_model(spark: SparkSession, model: Model, path: str) -> str:
    """Writes a new version of the model; returns it."""
    path = path.rstrip("/")
    if isinstance(model, LinearModel):
        kind, about = "ridge", {"intercept": model.intercept}
        rows = [(i, c, float(w)) for i, (c, w) in enumerate(zip(model.features, model.weights))]
        fits = spark.createDataFrame(rows, "place int, feature string, weight double")
    else:
        kind = next(k for k, c in CLASSICAL.items() if type(model) is c)
        about = {"spec": asdict(model.spec), "series": list(model.series), "order": list(model.order), "target": model.target}
        fits = model.table
    version = write_versioned(fits, f"{path}/fits")
    row = [(kind, json.dumps(about), version)]
    return write_versioned(spark.createDataFrame(row, "kind string, about string, fits string"), f"{path}/model")


def load_model(spark: SparkSession, path: str, version: str | None = None) -> Model:
    """The model last saved, or the version named."""
    path = path.rstrip("/")
    row = read_versioned(spark, f"{path}/model", version).first()
    about, fits = json.loads(row["about"]), read_versioned(spark, f"{path}/fits", row["fits"])
    if row["kind"] == "ridge":
        weights = fits.orderBy("place").collect()  # one row per feature
        return LinearModel(tuple(r["feature"] for r in weights), tuple(r["weight"] for r in weights), float(about["intercept"]))
    spec = ArxSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in about["spec"].items()})
    return CLASSICAL[row["kind"]](spec, tuple(about["series"]), tuple(about["order"]), about["target"], fits, fits.count())


def model_numbers(model: Model, spark: SparkSession) -> DataFrame:
    """``series..., term, value`` of any of the models."""
    if isinstance(model, LinearModel):
        rows = [("const", model.intercept), *((f"x_{c}", w) for c, w in zip(model.features, model.weights))]
        return spark.createDataFrame([(t, float(v)) for t, v in rows], "term string, value double")
    return model.coefficients().filter(F.col("value").isNotNull())
