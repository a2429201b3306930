"""Choosing an epoch from training histories, many runs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import MIN_DELTA, PATIENCE


def overfit_gap(history: DataFrame) -> DataFrame:
    return history.withColumn("overfit_gap", F.col("val_loss") - F.col("train_loss"))


def best_epoch(history: DataFrame, runs=("run_id",)) -> DataFrame:
    """Epoch of the lowest validation loss, the first one on ties."""
    rank = F.struct("val_loss", "epoch")
    best = F.min(F.when(F.col("val_loss").isNotNull(), rank))
    return history.groupBy(*runs).agg(best.alias("b")).select(
        *runs, F.col("b.epoch").alias("best_epoch"), F.col("b.val_loss").alias("best_val_loss")
    )


def early_stop_select(history: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
                      max_epochs: int | None = None, runs=("run_id",)) -> DataFrame:
    """Replays the stopping rule: an epoch counts only if it beats the best by more than ``min_delta``.

    All epochs count unless ``max_epochs`` is given. A run's history is one array
    of three numbers per epoch that a fold walks through.
    """
    if max_epochs is not None:
        history = history.filter(F.col("epoch") <= max_epochs)
    epochs = history.groupBy(*runs).agg(
        F.array_sort(F.collect_list(F.struct("epoch", "train_loss", "val_loss"))).alias("h")
    )
    start = F.struct(
        F.lit(float("inf")).alias("best"), F.lit(0).alias("best_epoch"),
        F.lit(None).cast("double").alias("gap"), F.lit(0).alias("waited"), F.lit(0).alias("last"),
        F.lit(False).alias("stopped"),
    )

    def step(s, e):
        better = F.coalesce(e.val_loss < s.best - min_delta, F.lit(False))
        waited = F.when(better, 0).otherwise(s.waited + 1)
        after = F.struct(
            F.when(better, e.val_loss).otherwise(s.best).alias("best"),
            F.when(better, e.epoch.cast("int")).otherwise(s.best_epoch).alias("best_epoch"),
            F.when(better, e.val_loss - e.train_loss).otherwise(s.gap).alias("gap"),
            waited.alias("waited"), e.epoch.cast("int").alias("last"), (waited >= patience).alias("stopped"),
        )
        return F.when(s.stopped, s).otherwise(after)

    return epochs.withColumn("s", F.aggregate("h", start, step)).select(
        *runs, F.col("s.best_epoch").alias("best_epoch"),
        F.when(F.col("s.best_epoch") > 0, F.col("s.best")).alias("best_val_loss"),
        F.col("s.gap").alias("gap_at_best"), F.col("s.last").alias("epochs_run"),
        F.col("s.stopped").alias("stopped_early"),
    )
