"""Positional slices and chronological splits. All filter on the row index, never on a global sort."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.calendar import naive
from ..schema import ARIMA_HOLDOUT_ROWS, SLOTS_PER_DAY, VALIDATION_FRACTION
from .timeline import Layout, order_key
from .windows import indexed

INDEX, ROWS = "row_index", "series_rows"
# Tables up to this many rows are sorted as they are; beyond, the edge is found first. The rows are the same.
SORTABLE = 1_000_000
EDGE_PARTS = 4096
EPOCH = datetime(1970, 1, 1)


def _at(df, series, order, layout, chunk_rows):
    return indexed(df, series, order, layout, chunk_rows, index=INDEX, total=ROWS)


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(INDEX, ROWS)


def _near_edge(df: DataFrame, n: int, order, last: bool, sortable: int) -> DataFrame:
    """Only the stretch of the first order column that holds the n outermost rows.

    A top-n makes every task hand its n best rows to one task. For thousands of
    rows out of a large table it is cheaper to count rows in a few thousand
    intervals first and to sort what lies at the edge; the bound also reaches
    the scan, so files elsewhere in time are skipped.
    """
    key = order_key(df, order[0])
    if key is None:
        return df
    rows, lo, hi = df.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if rows <= max(sortable, 4 * n) or lo is None:
        return df
    width = max(1, (hi - lo + 1) // EDGE_PARTS)
    counts = df.groupBy((key - F.pmod(key, F.lit(width))).alias("b")).agg(F.count(F.lit(1)).alias("c")).filter("b IS NOT NULL")
    seen, bound = 0, None
    for b, c in sorted(counts.collect(), reverse=last):  # at most EDGE_PARTS + 1 rows
        seen, bound = seen + c, b
        if seen >= n:
            break
    if seen < n:
        return df
    column, edge = F.col(order[0]), bound if last else bound + width
    kind = df.schema[order[0]].dataType
    if isinstance(kind, T.TimestampNTZType):
        edge = naive(EPOCH + timedelta(microseconds=edge))
    elif not isinstance(kind, T.IntegralType):
        column = key
    return df.filter(column >= edge) if last else df.filter((column < edge) | column.isNull())


def downsample(df: DataFrame, step: int = 4, series=(), order=("date",), layout: Layout | None = None,
               chunk_rows: int | None = None) -> DataFrame:
    """Every ``step``-th row, from the first."""
    return _plain(_at(df, series, order, layout, chunk_rows).filter(F.col(INDEX) % step == 0))


def first_rows(df: DataFrame, n: int, series=(), order=("date",), layout: Layout | None = None,
               chunk_rows: int | None = None, sortable: int | None = None) -> DataFrame:
    """The first n rows of each series; one series alone is a top-k, which needs no row index."""
    if not series:
        return _near_edge(df, n, order, False, SORTABLE if sortable is None else sortable).orderBy(*order).limit(n)
    return _plain(_at(df, series, order, layout, chunk_rows).filter(F.col(INDEX) < n))


def first_days(df: DataFrame, days: int = 7, **kw) -> DataFrame:
    return first_rows(df, days * SLOTS_PER_DAY, **kw)


def last_rows(df: DataFrame, n: int, series=(), order=("date",), layout: Layout | None = None,
              chunk_rows: int | None = None, sortable: int | None = None) -> DataFrame:
    """The last n rows of each series."""
    if not series:
        return _near_edge(df, n, order, True, SORTABLE if sortable is None else sortable).orderBy(*[F.desc(c) for c in order]).limit(n)
    return _plain(_at(df, series, order, layout, chunk_rows).filter(F.col(INDEX) >= F.col(ROWS) - n))


def temporal_split(df: DataFrame, fraction: float = VALIDATION_FRACTION, series=(), order=("date",),
                   layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Adds ``role``: ``train`` for the first ``int(n * (1 - fraction))`` rows, ``val`` for the rest."""
    at = _at(df, series, order, layout, chunk_rows)
    cut = F.floor(F.col(ROWS).cast("double") * F.lit(1 - fraction))
    return _plain(at.withColumn("role", F.when(F.col(INDEX) < cut, "train").otherwise("val")))


def holdout_tail(df: DataFrame, holdout: int = ARIMA_HOLDOUT_ROWS, fit_rows: int | None = None, series=(),
                 order=("date",), layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Adds ``role``: ``val`` for the last ``holdout`` rows, ``fit`` for all rows before.

    With ``fit_rows`` only so many of these, and earlier rows go.
    """
    at = _at(df, series, order, layout, chunk_rows)
    edge = F.col(ROWS) - holdout
    fit = F.col(INDEX) >= edge - fit_rows if fit_rows is not None else F.lit(True)
    role = F.when(F.col(INDEX) >= edge, "val").when(fit, "fit")
    return _plain(at.withColumn("role", role).filter(F.col("role").isNotNull()))


def rolling_band(df: DataFrame, columns=("load", "wind", "solar"), days: int = 14, start_day: int = 180,
                 series=(), order=("date",), layout: Layout | None = None,
                 chunk_rows: int | None = None) -> DataFrame:
    """A close-up of rolling statistics: raw value, short mean, long mean and the band one deviation wide.

    Takes ``days`` days from ``start_day``, or from the start when the series is too short for that.
    """
    n, start = days * SLOTS_PER_DAY, start_day * SLOTS_PER_DAY
    at = _at(df, series, order, layout, chunk_rows)
    begin = F.when(F.col(ROWS) >= start + n, F.lit(start)).otherwise(F.lit(0))
    out = at.filter((F.col(INDEX) >= begin) & (F.col(INDEX) < begin + n))
    bands = []
    for c in columns:
        mean, std = F.col(f"{c}_rmean_96"), F.col(f"{c}_rstd_96")
        bands += [F.col(c), F.col(f"{c}_rmean_4"), mean, (mean - std).alias(f"{c}_low"), (mean + std).alias(f"{c}_high")]
    return out.select(*series, *order, *bands)
