"""Lags, fills, rolling statistics, differences and sliding sequences.

Lags are by row, not by time, as in the model: a gap in the timeline shortens
the distance in hours. Run ``regular_grid`` first where the two must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..schema import LAG_BASE, LAGS, ROLLING, ROLLING_BASE, SEQUENCE_LENGTH, SLOTS_PER_DAY, TARGET, present
from ..session import materialize
from .timeline import BROADCAST_BUCKETS, CHUNK, FIRST, HOME, TOTAL, Layout, Timeline, open_timeline, plan_layout, tasks_for

DEFAULT_LAG_BASE = LAG_BASE + (TARGET,)
DEFAULT_ROLLING_BASE = ROLLING_BASE + (TARGET,)
# Windows this wide are computed block by block once rows x columns x width is
# large enough to pay for the extra sorts.
WIDE_WINDOW = 24
BLOCKWISE_FROM = 50_000_000
# Rolling windows sort a task's rows several times over, up to a kilobyte of memory a row: from this many rows on a table
# is cut into tasks by rows instead of bytes.
ROLL_ROWS = 262_144
FEW_TASKS = 8


def _lag_exprs(t: Timeline, columns, lags) -> dict[str, Column]:
    return {f"{c}_lag_{k}": F.lag(c, k).over(t.window) for c in columns for k in lags}


def _sliding(t: Timeline, columns, windows) -> dict[str, Column]:
    """Trailing statistics as plain window frames: each row visits its whole window."""
    out = {}
    for c in columns:
        for w in windows:
            frame = t.trailing(w)
            out[f"{c}_rmean_{w}"] = F.avg(c).over(frame)
            # one value has no sample deviation: count it as 0
            out[f"{c}_rstd_{w}"] = F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0))
    return out


def _moments(columns, frame, tag: str) -> dict[str, Column]:
    # names apart from those a chunked timeline carries (__start_{c} is a series' first value)
    return {
        f"__block_{tag}_{c}": F.struct(
            F.count(c).over(frame).alias("n"), F.avg(c).over(frame).alias("m"), F.var_pop(c).over(frame).alias("v"),
        )
        for c in columns
    }


def _blockwise(t: Timeline, df: DataFrame, columns, w: int) -> DataFrame:
    """The same statistics at a cost per row that does not grow with the window.

    Rows are cut into blocks of w. A window is the end of one block and the
    start of the next, and both are running aggregates: forward from the block's
    first row, backward from its last. The two parts' count, mean and variance
    combine exactly as those of two samples do.
    """
    number = (F.row_number().over(t.window) - 1).cast("int")
    cut = df.withColumn("__number", number).withColumn("__block", F.floor(F.col("__number") / w))
    by = [*t.by, "__block"]
    forward = W.partitionBy(*by).orderBy(*t.layout.order).rowsBetween(W.unboundedPreceding, 0)
    backward = W.partitionBy(*by).orderBy(*[F.desc(c) for c in t.layout.order]).rowsBetween(W.unboundedPreceding, 0)
    # backward last: the lag below needs it, so the planner cannot slip that lag's sort in between
    both = cut.withColumns(_moments(columns, forward, "start")).withColumns(_moments(columns, backward, "end"))
    # a window that fills its block exactly has no part in the block before
    spans = F.col("__number") % w != w - 1
    both = both.withColumns({f"__block_prior_{c}": F.when(spans, F.lag(f"__block_end_{c}", w - 1).over(t.window)) for c in columns})
    out = {}
    for c in columns:
        a, b = F.col(f"__block_start_{c}"), F.col(f"__block_prior_{c}")
        na, nb = a["n"].cast("double"), F.coalesce(b["n"], F.lit(0)).cast("double")
        n = na + nb
        ma, mb = F.coalesce(a["m"], b["m"]), F.coalesce(b["m"], a["m"])
        apart = mb - ma
        out[f"{c}_rmean_{w}"] = ma + apart * F.try_divide(nb, n)
        squares = (
            F.coalesce(a["v"], F.lit(0.0)) * na + F.coalesce(b["v"], F.lit(0.0)) * nb
            + apart * apart * F.try_divide(na * nb, n)
        )
        out[f"{c}_rstd_{w}"] = F.when(n > 1, F.sqrt(F.try_divide(squares, n - 1))).otherwise(F.lit(0.0))
    names = [f"__block_{tag}_{c}" for tag in ("end", "start", "prior") for c in columns]
    return both.withColumns(out).drop("__number", "__block", *names)


def _dealt(t: Timeline) -> Timeline:
    """Cuts a large timeline into tasks of about ``ROLL_ROWS`` rows, in the shuffle its windows need anyway."""
    tasks = tasks_for(t.layout.rows, ROLL_ROWS)
    if t.by and tasks >= FEW_TASKS:
        t.df = t.df.repartition(tasks, *t.by)
    return t


def _rolled(t: Timeline, df: DataFrame, columns, windows, more: dict[str, Column] | None = None) -> DataFrame:
    """Rolling columns (and ``more`` windowed columns) added to an open timeline's frame."""
    wide = [w for w in windows if w >= WIDE_WINDOW and t.layout.rows * len(columns) * w >= BLOCKWISE_FROM]
    for w in wide:
        df = _blockwise(t, df, columns, w)
    exprs = {**(more or {}), **_sliding(t, columns, [w for w in windows if w not in wide])}
    return df.withColumns(exprs) if exprs else df


def row_index(df: DataFrame, series=(), order=("date",), name: str = "row_index", layout: Layout | None = None,
              chunk_rows: int | None = None) -> DataFrame:
    """0-based row number per series in date order."""
    t = open_timeline(df, series, order, layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumn(name, t.position()))


def indexed(df: DataFrame, series=(), order=("date",), layout: Layout | None = None,
            chunk_rows: int | None = None, index: str = "row_index", total: str = "series_rows") -> DataFrame:
    """Row number and series length: the two facts every positional slice needs."""
    t = open_timeline(df, series, order, layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumns({index: t.position(), total: t.total()}))


def lag_features(df: DataFrame, columns=DEFAULT_LAG_BASE, lags=LAGS, series=(), order=("date",),
                 layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """``{column}_lag_{k}``: the value k rows back; columns the frame lacks are skipped."""
    cols = present(df, columns)
    if not cols or not lags:
        return df
    t = open_timeline(df, series, order, halo=max(lags), layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumns(_lag_exprs(t, cols, lags)))


def fill_lags(df: DataFrame, columns, series=(), order=("date",), layout: Layout | None = None,
              chunk_rows: int | None = None) -> DataFrame:
    """Forward-fill, then back-fill: what is still NULL leads the series and takes its first value."""
    cols = present(df, columns)
    if not cols:
        return df
    t = open_timeline(df, series, order, carry=cols, layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumns({c: F.coalesce(t.forward_filled(c), t.first_value(c)) for c in cols}))


def rolling_features(df: DataFrame, columns=DEFAULT_ROLLING_BASE, windows=ROLLING, series=(), order=("date",),
                     layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Trailing mean and sample deviation over the last w rows, current row included."""
    cols = present(df, columns)
    if not cols or not windows:
        return df
    t = _dealt(open_timeline(df, series, order, halo=max(windows) - 1, layout=layout, chunk_rows=chunk_rows))
    return t.close(_rolled(t, t.df, cols, windows))


def _lag_end_unclear(t: Timeline, df: DataFrame, columns, lags) -> bool:
    """Does some series have its first value of a column so late that a lag may never reach it?

    Decided on the bucket table: only the bucket holding the last ``max(lags)``
    rows can be in doubt.
    """
    table = t.bucket_table(df, columns)
    late = F.col(FIRST) + F.col("__n") > F.col(TOTAL) - max(lags)
    earlier = ~late
    keys = [*t.layout.series]
    flags = [
        F.max((earlier & F.col(f"__lead_{c}").isNotNull()).cast("int")).alias(f"f_{c}") for c in columns
    ]
    per_series = (table.groupBy(*keys) if keys else table).agg(*flags)
    worst = per_series.agg(F.min(F.least(*[F.coalesce(f"f_{c}", F.lit(0)) for c in columns], F.lit(1)))).first()[0]
    return worst == 0


def lag_and_roll(df: DataFrame, lag_base=DEFAULT_LAG_BASE, lags=LAGS, roll_base=DEFAULT_ROLLING_BASE,
                 windows=ROLLING, series=(), order=("date",), layout: Layout | None = None,
                 chunk_rows: int | None = None) -> DataFrame:
    """Filled lags and rolling statistics from one shuffle and one sort.

    Equal to ``rolling_features(fill_lags(lag_features(df)))``. A filled lag is
    the forward-filled column k rows back; rows before that take the column's
    first value, unless the series ends before any lagged value exists.
    """
    lag_cols, roll_cols = present(df, lag_base), present(df, roll_base)
    layout = layout or plan_layout(df, series, order, chunk_rows)
    halo = max([*lags, *(w - 1 for w in windows)])
    if not layout.chunked:
        t = _dealt(Timeline(df, layout))
        raw = _rolled(t, t.df, roll_cols, windows, _lag_exprs(t, lag_cols, lags))
        names = [f"{c}_lag_{k}" for c in lag_cols for k in lags]
        return t.close(raw.withColumns({
            n: F.coalesce(F.last(n, True).over(t.running), F.first(n, True).over(t.whole)) for n in names
        }))
    t = Timeline(df, layout, halo, carry=lag_cols)
    if lag_cols and _lag_end_unclear(t, df, lag_cols, lags):
        lagged = lag_features(df, lag_cols, lags, layout=layout)
        filled = fill_lags(lagged, [f"{c}_lag_{k}" for c in lag_cols for k in lags], layout=layout)
        return rolling_features(filled, roll_cols, windows, layout=layout)
    _dealt(t)
    step = _rolled(t, t.df, roll_cols, windows, {f"__g_{c}": t.forward_filled(c) for c in lag_cols})
    return t.close(step.withColumns({
        f"{c}_lag_{k}": F.coalesce(F.lag(f"__g_{c}", k).over(t.window), t.first_value(c))
        for c in lag_cols for k in lags
    }))


def difference(df: DataFrame, column: str = TARGET, lag: int = 1, times: int = 1, name: str | None = None,
               series=(), order=("date",), layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """y_t - y_{t-lag}, applied ``times`` times (lag 96 is the seasonal difference)."""
    name = name or f"{column}_diff_{lag}"
    if times == 0:
        return df.withColumn(name, F.col(column))
    t = open_timeline(df, series, order, halo=lag * times, layout=layout, chunk_rows=chunk_rows)
    # the d-th difference is a binomial sum of lags, so one window is enough
    value, weight = F.col(column), 1
    for i in range(1, times + 1):
        weight = weight * (times - i + 1) // i
        term = F.lag(column, i * lag).over(t.window) * float(weight)
        value = value - term if i % 2 else value + term
    return t.close(t.df.withColumn(name, value))


def undifference(df: DataFrame, diff: str, level: str, lag: int = 1, name: str = "restored", series=(),
                 order=("date",), layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Inverse of a single difference where the earlier level is known: y_t = diff_t + y_{t-lag}."""
    t = open_timeline(df, series, order, halo=lag, layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumn(name, F.col(diff) + F.lag(level, lag).over(t.window)))


def undifference_all(df: DataFrame, diff: str, level: str, d: int = 0, D: int = 0, m: int = SLOTS_PER_DAY, name: str = "restored",
                     series=(), order=("date",), layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Inverse of (1 - L)^d (1 - L^m)^D from the first d + m D levels alone: ``level`` isn't read beyond them.

    One differencing is undone by running sums over the rows of equal position modulo its lag, whose first entry is a
    known value of the stage before. Sums run inside chunks; a small table of sums per (chunk, residue) carries them over
    chunk borders, so neither a series nor a residue class meets in one task. After a missing difference the rows that
    depend on it are NULL. Series with fewer rows than levels needed keep their levels.
    """
    stages = [1] * d + [m] * D
    if not stages:
        return df.withColumn(name, F.col(diff))
    depth = sum(stages)
    layout = layout or plan_layout(df, series, order, chunk_rows)
    t = Timeline(df, layout, halo=depth)
    # what each stage's values are in the first rows, from the levels
    rows = t.df.withColumns({"__pos": t.position(), "__w0": F.when(t.position() < depth, F.col(level).cast("double"))})
    for i, lag in enumerate(stages[:-1], start=1):
        rows = rows.withColumn(f"__w{i}", F.col(f"__w{i - 1}") - F.lag(f"__w{i - 1}", lag).over(t.window))
    if layout.chunked:
        rows = rows.filter(HOME)
    keep = [c for c in df.columns]
    chunk = F.col(CHUNK) if layout.chunked else F.lit(0).cast("long")
    rows = materialize(rows.select(*keep, "__pos", chunk.alias("__part"), *[f"__w{i}" for i in range(len(stages))], F.col(diff).cast("double").alias("__x")))
    known = depth
    for i in reversed(range(len(stages))):
        lag, known = stages[i], known - stages[i]
        # seeds stand where this stage's values are known first, differences after them
        value = F.when(F.col("__pos") < known, F.lit(None)).when(F.col("__pos") < known + lag, F.col(f"__w{i}")).otherwise(F.col("__x"))
        gap = ((F.col("__pos") >= known) & F.col("__v").isNull()).cast("long")
        rows = rows.withColumn("__v", value).withColumns({"__gap": gap, "__class": F.col("__pos") % lag})
        before = None
        if layout.chunked:
            sums = materialize(rows.groupBy(*series, "__part", "__class").agg(F.sum("__v").alias("__s"), F.sum("__gap").alias("__g")))
            earlier = W.partitionBy(*series, "__class").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
            before = sums.select(*series, "__part", "__class", F.coalesce(F.sum("__s").over(earlier), F.lit(0.0)).alias("__sb"), F.coalesce(F.sum("__g").over(earlier), F.lit(0).cast("long")).alias("__gb"))
            count = sums.count()
            keys = [*series, "__part", "__class"]
            before = before.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__sb", "__gb")
            cond = None
            for k in keys:
                eq = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
                cond = eq if cond is None else cond & eq
            rows = rows.join(F.broadcast(before) if count <= BROADCAST_BUCKETS else before, cond).drop(*[f"__k_{k}" for k in keys])
        along = W.partitionBy(*series, "__part", "__class").orderBy("__pos").rowsBetween(W.unboundedPreceding, 0)
        total, gaps = F.sum("__v").over(along), F.sum("__gap").over(along)
        if before is not None:
            total, gaps = F.coalesce(total, F.lit(0.0)) + F.col("__sb"), gaps + F.col("__gb")
        restored = F.when((F.col("__pos") >= known) & (gaps == 0), total)
        rows = rows.withColumn("__x", restored).drop("__v", "__gap", "__class", "__sb", "__gb")
        if i and layout.chunked:
            rows = materialize(rows)
    return rows.withColumn(name, F.coalesce("__x", "__w0")).select(*keep, name)


def sequence_windows(df: DataFrame, features, target: str | None = None, length: int = SEQUENCE_LENGTH,
                     series=(), order=("date",), layout: Layout | None = None,
                     chunk_rows: int | None = None) -> DataFrame:
    """One sample per row that has ``length - 1`` rows before it: the rows' feature arrays and the last target.

    Stays lazy: a sample is ``length`` times a row, so score it in the same plan
    (``score_windows`` builds the windows inside the task instead).
    """
    layout = layout or plan_layout(df, series, order, chunk_rows)
    if layout.longest < length:
        raise ValueError(f"longest series has {layout.longest} rows but the sequence length is {length}")
    t = Timeline(df, layout, halo=length - 1)
    row = F.array(*[F.col(c).cast("float") for c in features])
    out = {
        "__pos": t.position(),
        "x": F.collect_list(row).over(t.trailing(length)),
    }
    if target is not None:
        out["y"] = F.col(target).cast("float")
    keep = [*layout.series, *layout.order, "x"] + (["y"] if target is not None else [])
    full = t.df.withColumns(out).filter(F.col("__pos") >= length - 1)
    return t.close(full).select(*keep)
