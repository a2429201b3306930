"""Row-ordered operators: gaps, lags, fills, rolling statistics, sequences, splits, slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.operators.folds import bounds_list, fold_bounds, walk_forward_folds
from slotcast.operators.quality import first_gaps, interval_gaps, interval_report
from slotcast.operators.slices import (
    downsample, first_days, first_rows, holdout_tail, last_rows, rolling_band, temporal_split,
)
from slotcast.operators.timeline import plan_layout
from slotcast.operators.windows import (
    difference, fill_lags, lag_and_roll, lag_features, rolling_features, row_index, sequence_windows, undifference,
    undifference_all,
)
from slotcast.plans.prepare import featured
from slotcast.sources.sampletables import PANEL_ORDER, event_series, market_imbalances, market_test, market_train, panel
from slotcast.operators.grid import merge_imbalances

from . import q, qs, register
from .samples import DOMAIN_SQL, EVENTS, MARKET, MERGED, PANEL, TEST, TRAIN, step1_sql

PW = "(PARTITION BY series ORDER BY date, l_orderkey, l_linenumber, l_partkey, value"
EW = "(PARTITION BY series ORDER BY ts, event_id"
PKEYS = "series, date, l_orderkey, l_linenumber, l_partkey"


def lag_sql(c: str, k: int, w: str) -> str:
    return f"lag({c}, {k}) OVER {w})"


def filled_sql(c: str, w: str) -> str:
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


def roll_sql(c: str, n: int, w: str) -> tuple[str, str]:
    frame = f"OVER {w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"avg({c}) {frame}", f"coalesce(stddev_samp({c}) {frame}, 0)"


GAPS = """steps AS (SELECT *, lag(date) OVER (ORDER BY date) AS previous FROM train)"""


@register("interval_gaps", f"""WITH {TRAIN}, {GAPS}
SELECT previous, date, {q("epoch(date - previous)", 'gap_seconds')} FROM steps
WHERE previous IS NOT NULL AND date - previous <> INTERVAL '15 minutes'""")
def _(spark, sf):
    return interval_gaps(market_train(spark, sf))


@register("interval_gaps_series", f"""WITH {EVENTS},
steps AS (SELECT *, lag(ts) OVER (PARTITION BY series ORDER BY ts, event_id) AS previous FROM es)
SELECT series, previous, ts, {q("(epoch_us(ts) - epoch_us(previous)) / 1000000", 'gap_seconds')} FROM steps
WHERE previous IS NOT NULL AND ts - previous <> INTERVAL '15 minutes'""")
def _(spark, sf):
    return interval_gaps(event_series(spark, sf), ("series",), "ts", ties=("event_id",), chunk_rows=512)


REPORT = """count(previous) AS total_intervals,
  count(*) FILTER (WHERE date - previous = INTERVAL '15 minutes') AS correct_intervals,
  count(previous) - count(*) FILTER (WHERE date - previous = INTERVAL '15 minutes') AS gap_count,
  count(previous) = count(*) FILTER (WHERE date - previous = INTERVAL '15 minutes') AS is_sequential"""


@register("interval_report", f"WITH {TRAIN}, {GAPS} SELECT {REPORT} FROM steps")
def _(spark, sf):
    return interval_report(market_train(spark, sf))


@register("interval_report_series", f"""WITH {PANEL},
steps AS (SELECT *, lag(date) OVER {PW}) AS previous FROM panel)
SELECT series, {REPORT.replace("'15 minutes'", "'1440 minutes'")} FROM steps GROUP BY series""")
def _(spark, sf):
    return interval_report(panel(spark, sf), ("series",), minutes=1440, ties=PANEL_ORDER[1:])


@register("first_gaps", f"""WITH {TRAIN}, {GAPS}
SELECT previous, date, {q("epoch(date - previous)", 'gap_seconds')} FROM steps
WHERE previous IS NOT NULL AND date - previous <> INTERVAL '15 minutes' ORDER BY date LIMIT 10""")
def _(spark, sf):
    return first_gaps(interval_gaps(market_train(spark, sf)))


LAGS = [(c, k) for c in ("wind", "solar", "load", "spread") for k in (1, 4, 96)]


@register("lag_features", f"""WITH {TRAIN} SELECT date, {qs(['wind', 'solar', 'load', 'spread'])},
  {', '.join(q(f'lag({c}, {k}) OVER (ORDER BY date)', f'{c}_lag_{k}') for c, k in LAGS)} FROM train""")
def _(spark, sf):
    return lag_features(market_train(spark, sf))


@register("lag_features_panel", f"""WITH {PANEL} SELECT {PKEYS}, {q('value')},
  {', '.join(q(lag_sql('value', k, PW), f'value_lag_{k}') for k in (1, 4, 96))} FROM panel""")
def _(spark, sf):
    return lag_features(panel(spark, sf).drop("quantity"), ("value",), series=("series",), order=PANEL_ORDER)


@register("lag_features_long", f"""WITH {EVENTS} SELECT series, ts, event_id, {q('value')},
  {', '.join(q(lag_sql('value', k, EW), f'value_lag_{k}') for k in (1, 4, 96))} FROM es""")
def _(spark, sf):
    # few long series: forced into chunks of 512 rows here
    return lag_features(event_series(spark, sf), ("value",), series=("series",), order=("ts", "event_id"), chunk_rows=512)


FILL_SRC = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


@register("fill_lags", f"""WITH {TRAIN}, l AS (SELECT date,
  {', '.join(f'lag({c}, {k}) OVER (ORDER BY date) AS {c}_lag_{k}' for c, k in LAGS)} FROM train)
SELECT date, {', '.join(q(filled_sql(f'{c}_lag_{k}', '(ORDER BY date'), f'{c}_lag_{k}') for c, k in LAGS)} FROM l""")
def _(spark, sf):
    names = [f"{c}_lag_{k}" for c, k in LAGS]
    return fill_lags(lag_features(market_train(spark, sf)), names).select("date", *names)


@register("fill_lags_long", f"""WITH {EVENTS}, v AS (SELECT series, ts, event_id, {FILL_SRC} AS value FROM es),
l AS (SELECT series, ts, event_id, lag(value, 96) OVER {EW}) AS value_lag_96 FROM v)
SELECT series, ts, event_id, {q(filled_sql('value_lag_96', EW), 'value_lag_96')} FROM l""")
def _(spark, sf):
    src = event_series(spark, sf).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    layout = plan_layout(src, ("series",), ("ts", "event_id"), 512)  # same rows in both steps
    return fill_lags(lag_features(src, ("value",), (96,), layout=layout), ["value_lag_96"], layout=layout).drop("value")


def _rolls(columns, w, stat):
    at = 0 if stat == "rmean" else 1
    return ", ".join(q(roll_sql(c, n, w)[at], f"{c}_{stat}_{n}") for c in columns for n in (4, 96))


MARKET_ROLL = ("wind", "solar", "load", "spread")


@register("rolling_mean", f"WITH {TRAIN} SELECT date, {_rolls(MARKET_ROLL, '(ORDER BY date', 'rmean')} FROM train")
def _(spark, sf):
    out = rolling_features(market_train(spark, sf))
    return out.select("date", *[c for c in out.columns if "_rmean_" in c])


@register("rolling_std", f"WITH {TRAIN} SELECT date, {_rolls(MARKET_ROLL, '(ORDER BY date', 'rstd')} FROM train")
def _(spark, sf):
    out = rolling_features(market_train(spark, sf))
    return out.select("date", *[c for c in out.columns if "_rstd_" in c])


@register("rolling_panel", f"""WITH {PANEL} SELECT {PKEYS}, {q('value')}, {_rolls(['value'], PW, 'rmean')},
  {_rolls(['value'], PW, 'rstd')} FROM panel""")
def _(spark, sf):
    return rolling_features(panel(spark, sf).drop("quantity"), ("value",), series=("series",), order=PANEL_ORDER)


@register("rolling_long", f"""WITH {EVENTS} SELECT series, ts, event_id, {q('value')}, {_rolls(['value'], EW, 'rmean')},
  {_rolls(['value'], EW, 'rstd')} FROM es""")
def _(spark, sf):
    return rolling_features(event_series(spark, sf), ("value",), series=("series",), order=("ts", "event_id"), chunk_rows=512)


def lag_roll_select(lag_cols, roll_cols, w):
    filled = ", ".join(q(filled_sql(f"{c}_lag_{k}", w), f"{c}_lag_{k}") for c in lag_cols for k in (1, 4, 96))
    return f"{filled}, {_rolls(roll_cols, w, 'rmean')}, {_rolls(roll_cols, w, 'rstd')}"


@register("lag_and_roll_panel", f"""WITH {PANEL}, l AS (SELECT *,
  {', '.join(f'{lag_sql("value", k, PW)} AS value_lag_{k}' for k in (1, 4, 96))} FROM panel)
SELECT {PKEYS}, {q('value')}, {lag_roll_select(['value'], ['value'], PW)} FROM l""")
def _(spark, sf):
    return lag_and_roll(panel(spark, sf).drop("quantity"), ("value",), roll_base=("value",), series=("series",), order=PANEL_ORDER)


@register("lag_and_roll_long", f"""WITH {EVENTS}, v AS (SELECT series, ts, event_id, {FILL_SRC} AS value FROM es),
l AS (SELECT *, {', '.join(f'{lag_sql("value", k, EW)} AS value_lag_{k}' for k in (1, 4, 96))} FROM v)
SELECT series, ts, event_id, {q('value')}, {lag_roll_select(['value'], ['value'], EW)} FROM l""")
def _(spark, sf):
    src = event_series(spark, sf).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return lag_and_roll(src, ("value",), roll_base=("value",), series=("series",), order=("ts", "event_id"), chunk_rows=512)


@register("row_index", f"""WITH {PANEL} SELECT {PKEYS}, {q('value')}, row_number() OVER {PW}) - 1 AS row_index FROM panel""")
def _(spark, sf):
    return row_index(panel(spark, sf).drop("quantity"), ("series",), PANEL_ORDER)


@register("row_index_long", """SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def _(spark, sf):
    # one single series, in chunks
    return row_index(event_series(spark, sf).select("event_id", "ts"), (), ("ts", "event_id"), chunk_rows=512)


def _seq_shown(df, keys, features):
    last, n = F.element_at("x", -1), F.size("x")
    out = [*keys, n.alias("length")]
    for i, c in enumerate(features):
        total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v[i].cast("double"))
        out += [F.col("x")[0][i].alias(f"first_{c}"), last[i].alias(f"last_{c}"), (total / n).alias(f"mean_{c}")]
    return df.select(*out, "y")


def _seq_sql(features, w):
    out = []
    for c in features:
        out += [q(f"lag({c}::FLOAT, 95) OVER {w})", f"first_{c}", 2), q(f"{c}::FLOAT", f"last_{c}", 2),
                q(f"avg({c}::FLOAT) OVER {w} ROWS BETWEEN 95 PRECEDING AND CURRENT ROW)", f"mean_{c}", 2)]
    return ", ".join(out)


@register("sequence_windows", f"""WITH {TRAIN}, s AS (SELECT date, 96::INTEGER AS length,
  {_seq_sql(['wind', 'solar', 'load'], '(ORDER BY date')}, {q('spread::FLOAT', 'y', 2)},
  row_number() OVER (ORDER BY date) AS rn FROM train)
SELECT * EXCLUDE (rn) FROM s WHERE rn >= 96""", digits=2)
def _(spark, sf):
    cols = ("wind", "solar", "load")
    return _seq_shown(sequence_windows(market_train(spark, sf), cols, "spread"), ["date"], cols)


@register("sequence_windows_panel", f"""WITH {PANEL}, s AS (SELECT {PKEYS}, 24::INTEGER AS length,
  {q(f'lag(quantity::FLOAT, 23) OVER {PW})', 'first_quantity', 2)}, {q('quantity::FLOAT', 'last_quantity', 2)},
  {q(f'avg(quantity::FLOAT) OVER {PW} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)', 'mean_quantity', 2)},
  {q('value::FLOAT', 'y', 2)}, row_number() OVER {PW}) AS rn FROM panel)
SELECT * EXCLUDE (rn) FROM s WHERE rn >= 24""", digits=2)
def _(spark, sf):
    seq = sequence_windows(panel(spark, sf), ("quantity",), "value", 24, ("series",), PANEL_ORDER)
    return _seq_shown(seq, list(("series", *PANEL_ORDER[:4])), ("quantity",))


@register("temporal_split", f"""WITH {TRAIN}, i AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n FROM train)
SELECT date, {q('spread')}, CASE WHEN pos < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'val' END AS role FROM i""")
def _(spark, sf):
    return temporal_split(market_train(spark, sf)).select("date", "spread", "role")


@register("temporal_split_panel", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) - 1 AS pos,
  count(*) OVER (PARTITION BY series) AS n FROM panel)
SELECT {PKEYS}, {q('value')}, CASE WHEN pos < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'val' END AS role FROM i""")
def _(spark, sf):
    return temporal_split(panel(spark, sf).drop("quantity"), series=("series",), order=PANEL_ORDER)


@register("holdout_tail", f"""WITH {TRAIN}, i AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS back FROM train)
SELECT date, {q('spread')}, CASE WHEN back <= 672 THEN 'val' ELSE 'fit' END AS role FROM i WHERE back <= 672 + 35040""")
def _(spark, sf):
    return holdout_tail(market_train(spark, sf)).select("date", "spread", "role")


@register("holdout_tail_panel", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) AS pos,
  count(*) OVER (PARTITION BY series) AS n FROM panel)
SELECT {PKEYS}, {q('value')}, CASE WHEN n - pos < 50 THEN 'val' ELSE 'fit' END AS role FROM i WHERE n - pos < 250""")
def _(spark, sf):
    return holdout_tail(panel(spark, sf).drop("quantity"), 50, 200, ("series",), PANEL_ORDER)


BOUNDS_MONTHS = """b AS (SELECT e0, e0 - INTERVAL '6 months' AS e1, e0 - INTERVAL '6 months' - INTERVAL '6 months' AS e2,
  e0 - INTERVAL '6 months' - INTERVAL '6 months' - INTERVAL '6 months' AS e3,
  e0 - INTERVAL '6 months' - INTERVAL '6 months' - INTERVAL '6 months' - INTERVAL '6 months' AS e4
  FROM (SELECT max(date) AS e0 FROM {t})),
bounds AS (SELECT 1::INTEGER AS fold_id, e4 AS val_start, e3 AS val_end FROM b UNION ALL SELECT 2, e3, e2 FROM b
  UNION ALL SELECT 3, e2, e1 FROM b UNION ALL SELECT 4, e1, e0 FROM b)"""
BOUNDS_DAYS = """b AS (SELECT max(date) AS e0 FROM train),
bounds AS (SELECT i::INTEGER AS fold_id, e0 - (5 - i) * INTERVAL '4 days' AS val_start,
  e0 - (4 - i) * INTERVAL '4 days' AS val_end FROM b, (SELECT unnest([1, 2, 3, 4]) AS i))"""


@register("fold_bounds", f"WITH {PANEL}, {BOUNDS_MONTHS.format(t='panel')} SELECT * FROM bounds")
def _(spark, sf):
    return fold_bounds(panel(spark, sf))


FOLD_ROWS = """r AS (SELECT t.date, t.spread, b.fold_id, CASE WHEN t.date < b.val_start THEN 'train' ELSE 'val' END AS role
  FROM train t, bounds b WHERE t.date < b.val_start OR t.date < b.val_end OR (b.fold_id = 4 AND t.date <= b.val_end)),
ok AS (SELECT fold_id FROM r GROUP BY 1 HAVING count(*) FILTER (WHERE role = 'train') >= 96
  AND count(*) FILTER (WHERE role = 'val') >= 96)"""


@register("walk_forward_folds", f"""WITH {TRAIN}, {BOUNDS_DAYS}, {FOLD_ROWS}
SELECT date, {q('spread')}, fold_id, role FROM r WHERE fold_id IN (SELECT fold_id FROM ok)""")
def _(spark, sf):
    return walk_forward_folds(market_train(spark, sf).select("date", "spread"), days=4)


@register("walk_forward_folds_panel", f"""WITH {PANEL}, {BOUNDS_MONTHS.format(t='panel')},
r AS (SELECT b.fold_id, CASE WHEN t.date < b.val_start THEN 'train' ELSE 'val' END AS role, t.value
  FROM panel t, bounds b WHERE t.date < b.val_start OR t.date < b.val_end OR (b.fold_id = 4 AND t.date <= b.val_end))
SELECT fold_id, role, count(*) AS rows, {q('avg(value)', 'mean_value')} FROM r GROUP BY 1, 2""")
def _(spark, sf):
    rows = walk_forward_folds(panel(spark, sf).select("date", "value"))
    return rows.groupBy("fold_id", "role").agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("mean_value"))


@register("rolling_band", f"""WITH {TRAIN}, i AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS n,
  {', '.join(f'{roll_sql(c, 4, "(ORDER BY date")[0]} AS {c}_rmean_4, {roll_sql(c, 96, "(ORDER BY date")[0]} AS {c}_rmean_96, {roll_sql(c, 96, "(ORDER BY date")[1]} AS {c}_rstd_96' for c in ('wind', 'solar', 'load'))}
  FROM train), w AS (SELECT *, CASE WHEN n >= 17280 + 1344 THEN 17280 ELSE 0 END AS b FROM i)
SELECT date, {', '.join(q(e, n) for c in ('load', 'wind', 'solar') for e, n in (
    (c, c), (f'{c}_rmean_4', f'{c}_rmean_4'), (f'{c}_rmean_96', f'{c}_rmean_96'),
    (f'{c}_rmean_96 - {c}_rstd_96', f'{c}_low'), (f'{c}_rmean_96 + {c}_rstd_96', f'{c}_high')))}
FROM w WHERE pos >= b AND pos < b + 1344""")
def _(spark, sf):
    return rolling_band(rolling_features(market_train(spark, sf)))


@register("downsample", f"""WITH {TRAIN}, i AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS pos FROM train)
SELECT date, {qs(['wind', 'solar', 'load', 'spread'])} FROM i WHERE pos % 4 = 0""")
def _(spark, sf):
    return downsample(market_train(spark, sf))


@register("downsample_panel", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) - 1 AS pos FROM panel)
SELECT {PKEYS}, {q('value')} FROM i WHERE pos % 4 = 0""")
def _(spark, sf):
    return downsample(panel(spark, sf).drop("quantity"), series=("series",), order=PANEL_ORDER)


@register("first_days", f"""WITH {TRAIN} SELECT date, {qs(['wind', 'solar', 'load', 'spread'])} FROM train ORDER BY date LIMIT 672""")
def _(spark, sf):
    return first_days(market_train(spark, sf))


@register("first_rows_panel", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) AS pos FROM panel)
SELECT {PKEYS}, {q('value')} FROM i WHERE pos <= 20""")
def _(spark, sf):
    return first_rows(panel(spark, sf).drop("quantity"), 20, series=("series",), order=PANEL_ORDER)


@register("last_n", f"""WITH {TRAIN} SELECT date, {qs(['wind', 'solar', 'load', 'spread'])} FROM train ORDER BY date DESC LIMIT 500""")
def _(spark, sf):
    return last_rows(market_train(spark, sf), 500)


@register("last_n_panel", f"""WITH {PANEL}, i AS (SELECT *, row_number() OVER {PW}) AS pos, count(*) OVER (PARTITION BY series) AS n FROM panel)
SELECT {PKEYS}, {q('value')} FROM i WHERE n - pos < 20""")
def _(spark, sf):
    return last_rows(panel(spark, sf).drop("quantity"), 20, series=("series",), order=PANEL_ORDER)


@register("difference", f"""WITH {TRAIN} SELECT date, {q('spread - lag(spread, 1) OVER (ORDER BY date)', 'spread_diff_1')},
  {q('spread - lag(spread, 96) OVER (ORDER BY date)', 'spread_diff_96')},
  {q('spread - 2 * lag(spread, 1) OVER (ORDER BY date) + lag(spread, 2) OVER (ORDER BY date)', 'spread_diff2')} FROM train""")
def _(spark, sf):
    df = market_train(spark, sf).select("date", "spread")
    out = difference(difference(difference(df, "spread", 1), "spread", 96), "spread", 1, 2, "spread_diff2")
    return out.drop("spread")


@register("undifference", f"""WITH {TRAIN}, i AS (SELECT *, row_number() OVER (ORDER BY date) AS pos FROM train)
SELECT date, {q('spread')}, {q('CASE WHEN pos > 96 THEN spread END', 'restored')} FROM i""")
def _(spark, sf):
    diffed = difference(market_train(spark, sf).select("date", "spread"), "spread", 96)
    return undifference(diffed, "spread_diff_96", "spread", 96).drop("spread_diff_96")


def _running(c: str, m: int, by: str = "") -> str:
    """(1 - L)(1 - L^m) undone by running sums of seeds and differences; ``i`` has 0-based ``pos``, the level and ``w``, ``z``."""
    part = f"PARTITION BY {by}, " if by else "PARTITION BY "
    whole = f"PARTITION BY {by} " if by else ""
    return f"""u AS (SELECT *, sum(CASE WHEN pos BETWEEN 1 AND {m} THEN w WHEN pos > {m} THEN z END) OVER ({part}pos % {m} ORDER BY pos) AS back FROM i)
SELECT {{}}, {q(f'sum(CASE WHEN pos = 0 THEN {c} ELSE back END) OVER ({whole}ORDER BY pos)', 'restored', 2)} FROM u"""


def _twice_differenced(df, column, m, by=(), order=("date",)):
    """The differences of both kinds, and the level in the first rows only."""
    kw = dict(series=by, order=order)
    both = difference(difference(df, column, 1, name="w1", **kw), "w1", m, name="diff", **kw).drop("w1")
    placed = row_index(both, by, order, name="at_row")
    return placed.withColumn("level", F.when(F.col("at_row") <= m, F.col(column))).drop("at_row")


@register("undifference_all", f"""WITH {TRAIN}, j AS (SELECT date, spread, row_number() OVER (ORDER BY date) - 1 AS pos, spread - lag(spread) OVER (ORDER BY date) AS w FROM train),
i AS (SELECT *, w - lag(w, 96) OVER (ORDER BY date) AS z FROM j), {_running('spread', 96).format('date')}""", digits=2)
def _(spark, sf):
    rows = _twice_differenced(market_train(spark, sf).select("date", "spread"), "spread", 96)
    return undifference_all(rows, "diff", "level", d=1, D=1, m=96, chunk_rows=500).select("date", "restored")


@register("undifference_all_panel", f"""WITH {PANEL}, j AS (SELECT *, row_number() OVER {PW}) - 1 AS pos, value - lag(value) OVER {PW}) AS w FROM panel),
i AS (SELECT *, w - lag(w, 7) OVER {PW}) AS z FROM j), {_running('value', 7, 'series').format(PKEYS)}""", digits=2)
def _(spark, sf):
    rows = _twice_differenced(panel(spark, sf).drop("quantity"), "value", 7, ("series",), PANEL_ORDER)
    return undifference_all(rows, "diff", "level", d=1, D=1, m=7, series=("series",), order=PANEL_ORDER).select("series", *PANEL_ORDER[:-1], "restored")


# --- the whole feature table --------------------------------------------------
FEATURED = f"""f1 AS ({step1_sql('merged')}), l1 AS (SELECT *,
  {', '.join(f'lag({c}, {k}) OVER (ORDER BY date) AS {c}_lag_{k}' for c in ('wind', 'solar', 'load', 'net_load', 'spread') for k in (1, 4, 96))} FROM f1)"""


@register("featured_train", f"""WITH {MERGED}, {FEATURED}
SELECT date, {', '.join(q(c) for c in ('net_load', 'renewable_ratio', 'imbalances', 'interval_sin'))},
  {lag_roll_select(['wind', 'solar', 'load', 'net_load', 'spread'], ['wind', 'solar', 'load', 'spread'], '(ORDER BY date')} FROM l1""")
def _(spark, sf):
    out = featured(merge_imbalances(market_train(spark, sf), market_imbalances(spark, sf)))
    keep = ["date", "net_load", "renewable_ratio", "imbalances", "interval_sin"]
    return out.select(*keep, *[c for c in out.columns if "_lag_" in c or "_rmean_" in c or "_rstd_" in c])


FEATURED_TEST = f"""f1 AS ({step1_sql('test')}), l1 AS (SELECT *,
  {', '.join(f'lag({c}, {k}) OVER (ORDER BY date) AS {c}_lag_{k}' for c in ('wind', 'solar', 'load', 'net_load') for k in (1, 4, 96))} FROM f1)"""


@register("featured_test", f"""WITH {MARKET}, {TEST}, {FEATURED_TEST}
SELECT "ID", date, {q('net_load')},
  {lag_roll_select(['wind', 'solar', 'load', 'net_load'], ['wind', 'solar', 'load'], '(ORDER BY date')} FROM l1""")
def _(spark, sf):
    out = featured(market_test(spark, sf))
    return out.select("ID", "date", "net_load", *[c for c in out.columns if "_lag_" in c or "_rmean_" in c or "_rstd_" in c])


__all__ = ["DOMAIN_SQL", "bounds_list"]
