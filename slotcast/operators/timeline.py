"""Row-ordered windows over series of any length.

A window partitioned by series alone puts a whole series into one task. That is
right for a million short series and wrong for one that holds a third of all
rows. ``plan_layout`` looks at the sizes first:

* if the longest series fits in ``chunk_rows``, windows partition by series;
* otherwise rows are counted per (series, bucket of the order column) - a table
  that is small because a bucket holds thousands of rows - and running sums over those counts give
  each bucket its first row position. Buckets are grouped into chunks of about
  ``chunk_rows`` rows, and the buckets holding the last ``halo`` rows before a
  chunk are copied into it. Windows then partition by (series, chunk), every row
  is shuffled once, and the answer is the same as over the whole series.

A bucket is an interval of the first order column. Its width starts where evenly
spread rows would give sixteen buckets per chunk and is divided until no bucket
is larger than a chunk, so a burst in time is split too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F, types as T

CHUNK_ROWS = 262_144
# A bucket table up to this many rows (under 40 MB with its carried values) is
# broadcast; a larger one is joined by shuffle.
BROADCAST_BUCKETS = 200_000
BUCKETS_PER_CHUNK = 16
# Rows a task gets where its work or its memory by far exceeds the bytes it reads.
TASK_ROWS = 131_072
DAY_MICROS = 86_400_000_000

CHUNK, HOME, FIRST, TOTAL = "__chunk", "__home", "__first", "__total"


def tasks_for(rows: int, task_rows: int = TASK_ROWS) -> int:
    """Number of tasks that grows with the rows, however few bytes they take."""
    return max(1, -(-rows // task_rows))


@dataclass(frozen=True)
class Layout:
    series: tuple[str, ...]
    order: tuple[str, ...]
    chunk_rows: int
    longest: int                       # rows of the longest series
    widths: tuple[int, ...] = ()       # bucket width per used order column
    buckets: int = 0
    rows: int = 0

    @property
    def chunked(self) -> bool:
        return bool(self.widths)

    def for_subset(self) -> "Layout | None":
        """Valid for any subset of the rows while nothing is chunked; else it must be measured anew."""
        return None if self.chunked else self


def order_key(df: DataFrame, name: str) -> Column | None:
    """The order column as an integer that sorts the same way, or None if it has no such form."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        # built from parts: a cast to TIMESTAMP would pass through the session zone
        return (
            F.unix_date(c.cast("date")).cast("long") * DAY_MICROS
            + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        )
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long") * DAY_MICROS
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    return None


def _bucket_names(widths) -> list[str]:
    return [f"__b{i}" for i in range(len(widths))]


def _with_buckets(df: DataFrame, order, widths) -> DataFrame:
    # key minus remainder stays in integers; a division through double would lose microseconds
    return df.withColumns({
        b: k - F.pmod(k, F.lit(w))
        for b, k, w in zip(_bucket_names(widths), (order_key(df, o) for o in order), widths)
    })


def _series_sizes(df: DataFrame, series, key: Column):
    """Longest series, and the range of the first order column. Combined before the shuffle: one row per series."""
    per = (df.groupBy(*series) if series else df).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")
    )
    return per.agg(F.max("n"), F.min("lo"), F.max("hi"), F.sum("n")).first()


def _bucket_sizes(df: DataFrame, series, order, widths):
    """Largest bucket and number of buckets."""
    names = _bucket_names(widths)
    counts = _with_buckets(df.select(*series, *order), order, widths).groupBy(*series, *names).agg(
        F.count(F.lit(1)).alias("n")
    )
    row = counts.agg(F.max("n").alias("largest"), F.count(F.lit(1)).alias("buckets")).first()
    return row["largest"] or 0, row["buckets"] or 0


def plan_layout(df: DataFrame, series=(), order=("date",), chunk_rows: int | None = None) -> Layout:
    """Measure series (and, for long ones, bucket) sizes over the key columns and choose a layout."""
    series, order = tuple(series), tuple(order)
    chunk_rows = CHUNK_ROWS if chunk_rows is None else chunk_rows
    usable = []
    for name in order:
        if order_key(df, name) is None:
            break
        usable.append(name)
    if not usable:
        raise ValueError(f"first order column {order[0]!r} must be a timestamp, date or integer")
    longest, lo, hi, rows = _series_sizes(df, series, order_key(df, order[0]))
    longest, rows = longest or 0, rows or 0
    if longest <= chunk_rows:
        return Layout(series, order, chunk_rows, longest, rows=rows)
    # evenly spread rows would fill a bucket to a sixteenth of a chunk
    widths = [max(1, (hi - lo + 1) * chunk_rows // (BUCKETS_PER_CHUNK * longest))]
    largest, buckets = _bucket_sizes(df, series, order, widths)
    while largest > chunk_rows:
        if widths[-1] > 1:
            widths[-1] = max(1, widths[-1] >> max(1, math.ceil(math.log2(largest / chunk_rows))))
        elif len(widths) < len(usable):
            # one exact key value is itself too large: split it along the next order column
            key = order_key(df, usable[len(widths)])
            lo, hi = df.agg(F.min(key), F.max(key)).first()
            widths.append(max(1, (hi - lo + 1) // (BUCKETS_PER_CHUNK * math.ceil(largest / chunk_rows))))
        else:
            break  # rows equal in every order column; the task's sort spills
        largest, buckets = _bucket_sizes(df, series, order, widths)
    return Layout(series, order, chunk_rows, longest, tuple(widths), buckets, rows)


class Timeline:
    """A frame ready for row-ordered windows; ``close`` returns it without helpers and copies."""

    def __init__(self, df: DataFrame, layout: Layout, halo: int = 0, carry=()):
        self.layout, self.halo = layout, halo
        self._source_columns = df.columns
        if not layout.chunked:
            self.df = df
            self.by = list(layout.series)
            return
        if halo > layout.chunk_rows:
            raise ValueError("halo must not be longer than a chunk")
        self.by = [*layout.series, CHUNK]
        self.df = self._spread(df, tuple(carry))

    # -- construction --------------------------------------------------------
    def bucket_table(self, df: DataFrame, carry=()) -> DataFrame:
        """One row per (series, bucket): first position, chunk, series total and carried values."""
        lay = self.layout
        names = _bucket_names(lay.widths)
        rank = F.col(lay.order[0]) if len(lay.order) == 1 else F.struct(*lay.order)
        aggs = [F.count(F.lit(1)).alias("__n")]
        for c in carry:
            seen = F.when(F.col(c).isNotNull(), rank)
            aggs += [F.max_by(c, seen).alias(f"__last_{c}"), F.min_by(c, seen).alias(f"__lead_{c}")]
        counts = _with_buckets(df, lay.order, lay.widths).groupBy(*lay.series, *names).agg(*aggs)
        along = W.partitionBy(*lay.series).orderBy(*names)
        before = along.rowsBetween(W.unboundedPreceding, -1)
        whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        table = counts.withColumns({
            FIRST: F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")),
            TOTAL: F.sum("__n").over(whole),
            **{f"__carry_{c}": F.last(f"__last_{c}", True).over(before) for c in carry},
            **{f"__start_{c}": F.first(f"__lead_{c}", True).over(whole) for c in carry},
        })
        return table.withColumn(CHUNK, F.floor(F.col(FIRST) / lay.chunk_rows).cast("long"))

    def _spread(self, df: DataFrame, carry) -> DataFrame:
        lay = self.layout
        names = _bucket_names(lay.widths)
        table = self.bucket_table(df, carry)
        keep = [F.col(FIRST), F.col(TOTAL), F.col(CHUNK).alias("__own")]
        keep += [F.col(f"__{kind}_{c}") for c in carry for kind in ("carry", "start")]
        if self.halo:
            # chunks that begin within `halo` rows after this bucket ends need a copy of it
            reach = W.partitionBy(*lay.series).orderBy(FIRST).rangeBetween(0, self.halo - 1)
            table = table.withColumn("__soon", F.collect_set(CHUNK).over(reach))
            nxt = F.lead("__soon").over(W.partitionBy(*lay.series).orderBy(*names))
            keep.append(
                F.array_distinct(F.concat(F.array(CHUNK), F.coalesce(nxt, F.array().cast("array<long>"))))
                .alias("__to")
            )
        keys = [*lay.series, *names]
        small = table.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *keep)
        if lay.buckets <= BROADCAST_BUCKETS:
            small = F.broadcast(small)
        left = _with_buckets(df, lay.order, lay.widths)
        cond = None
        for k in keys:
            eq = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
            cond = eq if cond is None else cond & eq
        joined = left.join(small, cond).drop(*names, *[f"__k_{k}" for k in keys])
        if self.halo:
            joined = joined.withColumn(CHUNK, F.explode("__to")).drop("__to")
        else:
            joined = joined.withColumn(CHUNK, F.col("__own"))
        return joined.withColumn(HOME, F.col(CHUNK) == F.col("__own")).drop("__own")

    # -- window pieces -------------------------------------------------------
    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.by).orderBy(*self.layout.order)

    def trailing(self, rows: int) -> WindowSpec:
        """The current row and the ``rows - 1`` before it."""
        return self.window.rowsBetween(-(rows - 1), 0)

    @property
    def running(self) -> WindowSpec:
        return self.window.rowsBetween(W.unboundedPreceding, 0)

    @property
    def whole(self) -> WindowSpec:
        return self.window.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def position(self) -> Column:
        """0-based row number within the series."""
        number = F.row_number().over(self.window).cast("long") - 1
        return number + F.first(FIRST).over(self.running) if self.layout.chunked else number

    def total(self) -> Column:
        """Rows in the series."""
        return F.col(TOTAL) if self.layout.chunked else F.count(F.lit(1)).over(self.whole)

    def forward_filled(self, column: str) -> Column:
        """Last non-NULL value up to this row (``column`` must be in ``carry`` when chunked)."""
        seen = F.last(column, True).over(self.running)
        if not self.layout.chunked:
            return seen
        return F.coalesce(seen, F.first(f"__carry_{column}").over(self.running))

    def first_value(self, column: str) -> Column:
        """First non-NULL value of the series."""
        return F.col(f"__start_{column}") if self.layout.chunked else F.first(column, True).over(self.whole)

    def close(self, df: DataFrame) -> DataFrame:
        if self.layout.chunked:
            df = df.filter(HOME)
        return df.drop(*[c for c in df.columns if c.startswith("__")])


def open_timeline(
    df: DataFrame, series=(), order=("date",), halo: int = 0, carry=(),
    layout: Layout | None = None, chunk_rows: int | None = None,
) -> Timeline:
    if layout is None:
        layout = plan_layout(df, series, order, chunk_rows)
    return Timeline(df, layout, halo, carry)
