"""Regular 15-minute grid, median fill, joins on the date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import DATE, INTERVAL_MINUTES
from ..session import materialize
from .quantiles import BROADCAST_INTERVALS, SMALL, exact_quantiles, quantile_table


def sort_by_date(df: DataFrame, ties=(), ts: str = DATE) -> DataFrame:
    """Global ascending order by date (range-partitioned by Spark); ``ties`` makes it total."""
    return df.orderBy(ts, *ties)


def merge_imbalances(train: DataFrame, imbalances: DataFrame, ts: str = DATE) -> DataFrame:
    """Left join on the date; repeated dates on the right repeat the train row."""
    return train.join(imbalances, ts, "left")


def duplicate_slots(df: DataFrame, series=(), ts: str = DATE) -> DataFrame:
    return df.groupBy(*series, ts).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def grid_spine(df: DataFrame, series=(), ts: str = DATE, minutes: int = INTERVAL_MINUTES) -> DataFrame:
    """Every slot from a series' first to its last date, spaced from the first date.

    Days are exploded first and slots within a day second, so no row ever holds
    more than one day of slots.
    """
    step = F.expr(f"INTERVAL '{minutes}' MINUTE")
    ends = (df.groupBy(*series) if series else df).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    blocks = ends.filter("__lo IS NOT NULL").withColumn(
        "__day", F.explode(F.sequence("__lo", "__hi", F.expr(f"INTERVAL '{minutes * 96}' MINUTE")))
    )
    last = F.least(F.col("__hi"), F.col("__day") + F.expr(f"INTERVAL '{minutes * 95}' MINUTE"))
    return blocks.select(*series, F.explode(F.sequence("__day", last, step)).alias(ts))


def regular_grid(df: DataFrame, series=(), ts: str = DATE, minutes: int = INTERVAL_MINUTES,
                 check: bool = True) -> DataFrame:
    """One row per slot; slots without data are NULL in every other column. Repeated dates are an error."""
    if check and not duplicate_slots(df, series, ts).isEmpty():
        raise ValueError(f"repeated values of {ts!r}: cannot place rows on a regular grid")
    joined = grid_spine(df, series, ts, minutes).join(df, [*series, ts], "left")
    return joined.select(*df.columns)


def median_fill(df: DataFrame, column: str = "spread", by: DataFrame | None = None, series=(), small: int = SMALL) -> DataFrame:
    """Missing values become the median of the column (of ``by``'s column, when given), with ``series`` that of their series.

    A series without any value keeps its missing ones. Series of more than ``small`` values are narrowed by counting, so
    no task holds one.
    """
    if series:
        medians = materialize(quantile_table(by if by is not None else df, column, [0.5], ["__median"], series, small))
        lone = [F.col(k).alias(f"__k_{k}") for k in series]
        cond = F.lit(True)
        for k in series:
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        count = medians.count()
        medians = medians.select(*lone, "__median")
        filled = df.join(F.broadcast(medians) if count <= BROADCAST_INTERVALS else medians, cond, "left")
        return filled.withColumn(column, F.coalesce(F.col(column), F.col("__median"))).select(*df.columns)
    (median,) = exact_quantiles(by if by is not None else df, column, [0.5])
    if median is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(median)))
