"""Expanding walk-forward folds, built backwards from the last date in whole months (or any interval)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import naive
from ..schema import CV_FOLDS, CV_MONTHS, DATE, SEQUENCE_LENGTH


def fold_bounds(df: DataFrame, folds: int = CV_FOLDS, months: int = CV_MONTHS, days: int = 0,
                ts: str = DATE) -> DataFrame:
    """``fold_id, val_start, val_end`` in time order. Each fold ends where the next begins.

    The step is repeated from the previous bound, so month ends clip step by step
    (12-31, 06-30, 12-30). ``days`` steps by days instead, for short histories.
    """
    step = F.expr(f"INTERVAL '{days}' DAY") if days else F.expr(f"INTERVAL '{months}' MONTH")
    end = F.col("data_end")
    bounds = []
    for i in range(folds, 0, -1):
        start = end - step
        bounds.append(F.struct(F.lit(i).alias("fold_id"), start.alias("val_start"), end.alias("val_end")))
        end = start
    return df.agg(F.max(ts).alias("data_end")).select(F.inline(F.array(*reversed(bounds))))


def bounds_list(df: DataFrame, **kw) -> list[tuple]:
    """The few fold bounds as Python values, for use as literals."""
    return [(r["fold_id"], r["val_start"], r["val_end"]) for r in fold_bounds(df, **kw).collect()]


def _sides(bounds: list[tuple], ts: str):
    """(fold, is-train, is-val) conditions per fold. Bounds are literals, so roles are a projection, not a join."""
    t = F.col(ts)
    for i, (fold, start, end) in enumerate(bounds):
        start, end = naive(start), naive(end)
        yield fold, t < start, (t >= start) & (t <= end if i == len(bounds) - 1 else t < end)


def fold_roles(df: DataFrame, bounds: list[tuple], ts: str = DATE) -> DataFrame:
    """One row per (row, fold it takes part in)."""
    parts = []
    for fold, train, val in _sides(bounds, ts):
        role = F.when(train, "train").when(val, "val")
        parts.append(F.when(role.isNotNull(), F.struct(F.lit(fold).alias("fold_id"), role.alias("role"))))
    return df.select(*df.columns, F.inline(F.array_compact(F.array(*parts))))


def fold_sizes(df: DataFrame, bounds: list[tuple], ts: str = DATE) -> dict[int, tuple[int, int]]:
    """Train and validation rows per fold, counted side by side in one pass."""
    row = df.agg(*[
        F.count_if(side).alias(f"{name}_{fold}")
        for fold, train, val in _sides(bounds, ts) for name, side in (("train", train), ("val", val))
    ]).first()
    return {fold: (row[f"train_{fold}"], row[f"val_{fold}"]) for fold, _, _ in bounds}


def usable_bounds(df: DataFrame, bounds: list[tuple], min_rows: int = SEQUENCE_LENGTH, ts: str = DATE) -> list[tuple]:
    """Bounds of the folds that have enough rows on both sides."""
    sizes = fold_sizes(df, bounds, ts) if bounds else {}
    return [b for b in bounds if min(sizes[b[0]]) >= min_rows]


def walk_forward_folds(df: DataFrame, folds: int = CV_FOLDS, months: int = CV_MONTHS, days: int = 0,
                       min_rows: int = SEQUENCE_LENGTH, ts: str = DATE) -> DataFrame:
    """Rows with ``fold_id`` and ``role``; a row in several folds' training part appears once per fold.

    A fold is dropped as a whole when either side has fewer than ``min_rows`` rows.
    Only the last fold's validation part includes its end.
    """
    bounds = bounds_list(df, folds=folds, months=months, days=days, ts=ts)
    keep = [b[0] for b in usable_bounds(df, bounds, min_rows, ts)]
    return fold_roles(df, bounds, ts).filter(F.col("fold_id").isin(keep) if keep else F.lit(False))
