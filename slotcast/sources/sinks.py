"""Writers: prepared tables, submissions, metric tables and fitted state."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.calibrate import Calibrator
from ..operators.regimes import Regimes
from ..operators.scaling import ScalerStats
from ..operators.timeline import Layout
from ..operators.windows import row_index
from ..schema import DATE, FeatureConfig

CV_COLUMNS = (
    "fold_id", "train_start", "train_end", "val_start", "val_end", "train_rows", "val_rows", "best_epoch",
    "val_mae", "val_rmse", "val_r2", "overfit_gap",
)
HISTORY_COLUMNS = ("epoch", "train_loss", "val_loss", "overfit_gap", "learning_rate")


def write_prepared(df: DataFrame, path: str, ts: str = DATE, kind: str = "parquet") -> None:
    """Prepared table by month, sorted by date inside each file.

    Rows are range-partitioned by date before the write, so a month's rows sit
    in few files and a reader of one month or one date range skips the rest.
    """
    if kind == "csv":
        df.repartitionByRange(F.col(ts)).sortWithinPartitions(ts).write.mode("overwrite").option("header", True).csv(path)
        return
    month = F.date_format(ts, "yyyy-MM")
    (
        df.withColumn("month_key", month).repartitionByRange("month_key", ts).sortWithinPartitions("month_key", ts)
        .write.mode("overwrite").partitionBy("month_key").parquet(path)
    )


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("month_key")


def submission(df: DataFrame, probability: str = "probability", order=(DATE,), layout: Layout | None = None) -> DataFrame:
    """``ID, forecast``. Rows that have no ID because a grid added them are not part of a submission."""
    if "ID" not in df.columns:
        df = row_index(df, order=order, name="ID", layout=layout)
    return df.filter(F.col("ID").isNotNull()).select(F.col("ID").cast("long").alias("ID"), F.col(probability).alias("forecast"))


def write_submission(df: DataFrame, path: str, probability: str = "probability") -> None:
    submission(df, probability).sortWithinPartitions("ID").write.mode("overwrite").option("header", True).csv(path)


POINTERS = "versions"


def write_versioned(df: DataFrame, path: str) -> str:
    """Writes a new version of a table and, once it is whole, a pointer to it; returns the version.

    A version is a folder of its own, and pointers are rows appended to a small table beside it, so a job that fails on
    the way leaves readers with the version before, and readers of that version undisturbed.
    """
    spark, path, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    df.write.parquet(f"{path}/data-{version}")
    pointer = spark.createDataFrame([(version,)], "version string").withColumn("written", F.current_timestamp())
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/{POINTERS}")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``version, written`` of all whole versions."""
    return spark.read.schema("version string, written timestamp").parquet(f"{path.rstrip('/')}/{POINTERS}")


def read_versioned(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The version last pointed to, or the one named."""
    if version is None:
        version = versions(spark, path).orderBy(F.desc("written"), F.desc("version")).first()["version"]
    return spark.read.parquet(f"{path.rstrip('/')}/data-{version}")


def write_cv(folds: DataFrame, path: str) -> str:
    """Per-fold metrics; a closed-form fit has no epochs, so ``best_epoch`` is empty unless given."""
    if "best_epoch" not in folds.columns:
        folds = folds.withColumn("best_epoch", F.lit(None).cast("int"))
    return write_versioned(folds.select(*CV_COLUMNS), path)


def write_history(history: DataFrame, path: str) -> str:
    columns = [c for c in HISTORY_COLUMNS if c in history.columns]
    extra = [c for c in history.columns if c not in columns]
    return write_versioned(history.select(*extra, *columns), path)


def save_state(spark: SparkSession, folder: str, scaler: ScalerStats | None = None, regimes: Regimes | None = None,
               calibrator: Calibrator | None = None, config: FeatureConfig | None = None) -> None:
    """Fitted numbers as small tables; no pickles, so any engine can read them."""
    folder = folder.rstrip("/")
    if scaler is not None:
        scaler.to_frame(spark).write.mode("overwrite").parquet(f"{folder}/scaler")
    if regimes is not None:
        regimes.to_frame(spark).withColumn("inertia", F.lit(regimes.inertia)).write.mode("overwrite").parquet(f"{folder}/regimes")
    if calibrator is not None:
        calibrator.to_frame(spark).write.mode("overwrite").parquet(f"{folder}/calibrator")
    if config is not None:
        rows = [(k, json.dumps(v)) for k, v in asdict(config).items()]
        spark.createDataFrame(rows, "name string, value string").write.mode("overwrite").parquet(f"{folder}/config")


def load_scaler(spark: SparkSession, folder: str) -> ScalerStats:
    return ScalerStats.from_frame(spark.read.parquet(f"{folder.rstrip('/')}/scaler"))


def load_regimes(spark: SparkSession, folder: str) -> Regimes:
    frame = spark.read.parquet(f"{folder.rstrip('/')}/regimes")
    return Regimes.from_frame(frame.drop("inertia"), frame.first()["inertia"])


def load_calibrator(spark: SparkSession, folder: str) -> Calibrator:
    return Calibrator.from_frame(spark.read.parquet(f"{folder.rstrip('/')}/calibrator"))


def load_config(spark: SparkSession, folder: str) -> FeatureConfig:
    values = {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(f"{folder.rstrip('/')}/config").collect()}
    return FeatureConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
