"""Table summaries and checks of the 15-minute rhythm."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import DATE, INTERVAL_MINUTES
from .timeline import Layout, open_timeline


def data_summary(tables: dict[str, DataFrame], ts: str = DATE) -> DataFrame:
    """Rows, columns, first and last date and missing values, one row per (table, column)."""
    out = None
    for name, df in tables.items():
        values = [c for c in df.columns if c != ts]
        row = df.agg(
            F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_date"), F.max(ts).alias("last_date"),
            *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns],
        )
        pairs = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("missing")) for c in [ts, *values]
        ])
        part = row.select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
            "first_date", "last_date", F.inline(pairs),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _steps(df: DataFrame, series, ts, ties, layout: Layout | None, chunk_rows) -> DataFrame:
    t = open_timeline(df, series, (ts, *ties), halo=1, layout=layout, chunk_rows=chunk_rows)
    return t.close(t.df.withColumn("previous", F.lag(ts).over(t.window)))


def interval_gaps(df: DataFrame, series=(), ts: str = DATE, minutes: int = INTERVAL_MINUTES, ties=(),
                  layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Rows whose distance to the row before is not exactly one interval, with that distance in seconds."""
    step = F.expr(f"INTERVAL '{minutes}' MINUTE")
    gap = F.col(ts) - F.col("previous")
    seconds = gap.cast("interval second").cast("decimal(20,6)").cast("double")
    return (
        _steps(df.select(*series, ts, *ties), series, ts, ties, layout, chunk_rows)
        .filter(F.col("previous").isNotNull() & (gap != step))
        .select(*series, "previous", ts, seconds.alias("gap_seconds"))
    )


def interval_report(df: DataFrame, series=(), ts: str = DATE, minutes: int = INTERVAL_MINUTES, ties=(),
                    layout: Layout | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Distances in total, exact ones, gaps, and whether there is none."""
    step = F.expr(f"INTERVAL '{minutes}' MINUTE")
    steps = _steps(df.select(*series, ts, *ties), series, ts, ties, layout, chunk_rows)
    counts = (steps.groupBy(*series) if series else steps).agg(
        F.count("previous").alias("total_intervals"),
        F.count_if(F.col(ts) - F.col("previous") == step).alias("correct_intervals"),
    )
    gaps = F.col("total_intervals") - F.col("correct_intervals")
    return counts.withColumns({"gap_count": gaps, "is_sequential": gaps == 0})


def first_gaps(gaps: DataFrame, n: int = 10, ts: str = DATE, series=()) -> DataFrame:
    """The earliest gaps (top-k: each task keeps n rows)."""
    return gaps.orderBy(ts, *series).limit(n)
