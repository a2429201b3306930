"""Projections: calendar, Fourier and domain columns, fills, scaling, sign labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.functions.calendar import (
    arimax_exog, fourier_arimax, fourier_sarima, sarima_exog, temporal_cyclical, temporal_parts,
)
from slotcast.functions.domain import domain_features, sign_label
from slotcast.operators.grid import median_fill, regular_grid
from slotcast.operators.scaling import (
    exog_stats, fit_scaler, inverse_scale, scale_train, scaler_table, scaling_summary, standardize_exog, target_range,
)
from slotcast.schema import SCALED_STEP1
from slotcast.sources.sampletables import event_series, market_test, market_train, table

from . import q, qs, register
from .samples import (
    DOMAIN_SQL, DOW, EVENTS, GRID, MARKET, PARTS, SLOT, STEP1_CTE, STEP1_SCALED, TEST, TRAIN, WAVES, step1_scaled, step1_tables,
)

WEEK = f"({DOW} * 96 + {SLOT})"
ARIMAX_WAVES = {
    **{f"{f}_daily_{k}": f"{f}(2 * pi() * {k} * hour(date) / 24.0)" for k in (1, 2, 3) for f in ("sin", "cos")},
    **{f"{f}_weekly_{k}": f"{f}(2 * pi() * {k} * {WEEK} / 672.0)" for k in (1, 2) for f in ("sin", "cos")},
}
SARIMA_WAVES = {
    **{f"{f}_d{k}": f"{f}(2 * pi() * {k} * {SLOT} / 96.0)" for k in (1, 2, 3) for f in ("sin", "cos")},
    **{f"{f}_w{k}": f"{f}(2 * pi() * {k} * {WEEK} / 672.0)" for k in (1, 2) for f in ("sin", "cos")},
}
HDM = f"hour(date)::INTEGER AS hour, {DOW}::INTEGER AS dow, month(date)::INTEGER AS month"


@register("temporal_parts", f"SELECT event_id, ts, {PARTS.replace('date', 'ts')} FROM events")
def _(spark, sf):
    return temporal_parts(table(spark, sf, "events").select("event_id", "ts"), "ts")


@register("temporal_cyclical", "SELECT event_id, ts, " + ", ".join(
    q(e.replace("date", "ts"), n, 6) for n, e in WAVES.items()) + " FROM events", digits=6)
def _(spark, sf):
    return temporal_cyclical(table(spark, sf, "events").select("event_id", "ts"), "ts")


@register("domain_features", f"""WITH {TRAIN} SELECT date, {qs(['wind', 'solar', 'load', 'spread'])},
  {', '.join(q(e, n) for n, e in DOMAIN_SQL.items())} FROM train""")
def _(spark, sf):
    return domain_features(market_train(spark, sf))


@register("fourier_arimax", f"""WITH {TRAIN} SELECT date, {HDM},
  {', '.join(q(e, n, 6) for n, e in ARIMAX_WAVES.items())} FROM train""", digits=6)
def _(spark, sf):
    return fourier_arimax(market_train(spark, sf)).drop("wind", "solar", "load", "spread")


SARIMA_DOMAIN = {
    "net_load": "load - wind - solar",
    "renewable_ratio": "(wind + solar) / CASE WHEN load < 1 THEN 1 ELSE load END",
    "total_renewable": "wind + solar",
}


@register("fourier_sarima", f"""WITH {TRAIN} SELECT date, {HDM}, ({DOW} >= 5)::INTEGER AS is_weekend,
  {', '.join(q(e, n) for n, e in {**SARIMA_WAVES, **SARIMA_DOMAIN}.items())} FROM train""")
def _(spark, sf):
    return fourier_sarima(market_train(spark, sf)).drop("wind", "solar", "load", "spread")


@register("median_fill", f"""WITH {TRAIN}, {GRID.format(t='train')},
g AS (SELECT s.date, t.spread FROM spine s LEFT JOIN train t ON s.date = t.date)
SELECT date, {q('coalesce(spread, (SELECT quantile_cont(spread, 0.5) FROM g))', 'spread')} FROM g""")
def _(spark, sf):
    return median_fill(regular_grid(market_train(spark, sf).select("date", "spread")))


@register("median_fill_series", f"""WITH {EVENTS}, h AS (SELECT series, ts, event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM es)
SELECT series, ts, event_id, {q('coalesce(value, quantile_cont(value, 0.5) OVER (PARTITION BY series))', 'value')} FROM h""")
def _(spark, sf):
    holes = event_series(spark, sf).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return median_fill(holes, "value", series=("series",), small=512)


def _z(columns, source, digits=4, guard=False):
    out = []
    for c in columns:
        z = (f"({c} - (SELECT avg({c}) FROM {source})) / "
             f"coalesce(nullif((SELECT stddev_samp({c}) FROM {source}), 0), 1)")
        out.append(q(f"coalesce({z}, 0)", c, digits))
    return ", ".join(out)


@register("standardize_exog", f"""WITH {TRAIN}, {GRID.format(t='train')},
g AS (SELECT s.date, t.wind, t.solar, t.load FROM spine s LEFT JOIN train t ON s.date = t.date),
f AS (SELECT *, {HDM}, {', '.join(f'{e} AS {n}' for n, e in ARIMAX_WAVES.items())} FROM g)
SELECT date, {_z(arimax_exog(), 'f')} FROM f""")
def _(spark, sf):
    f = fourier_arimax(regular_grid(market_train(spark, sf)))
    cols = arimax_exog()
    return standardize_exog(f, exog_stats(f, cols), cols).select("date", *cols)


@register("standardize_exog_test", f"""WITH {TRAIN}, {TEST},
f AS (SELECT *, {HDM}, ({DOW} >= 5)::INTEGER AS is_weekend,
  {', '.join(f'{e} AS {n}' for n, e in {**SARIMA_WAVES, **SARIMA_DOMAIN}.items())} FROM train),
h AS (SELECT *, {HDM}, ({DOW} >= 5)::INTEGER AS is_weekend,
  {', '.join(f'{e} AS {n}' for n, e in {**SARIMA_WAVES, **SARIMA_DOMAIN}.items())} FROM test)
SELECT "ID", date, {_z(sarima_exog(), 'f')} FROM h""")
def _(spark, sf):
    cols = sarima_exog()
    stats = exog_stats(fourier_sarima(market_train(spark, sf)), cols)
    return standardize_exog(fourier_sarima(market_test(spark, sf)), stats, cols, False).select("ID", "date", *cols)


@register("scaler_fit", f"""WITH {STEP1_CTE} {' UNION ALL '.join(
    f"SELECT '{c}' AS column, {q(f'avg({c})', 'mean')}, {q(f'coalesce(nullif(stddev_pop({c}), 0), 1)', 'scale')} FROM train1"
    for c in STEP1_SCALED)}""")
def _(spark, sf):
    return scaler_table(step1_tables(spark, sf)[0], SCALED_STEP1)


SCALED_SHOWN = [*STEP1_SCALED]


@register("scale_train", f"WITH {STEP1_CTE} SELECT date, {qs([*SCALED_SHOWN, 'spread', 'spread_scaled'])} FROM train_s")
def _(spark, sf):
    return step1_scaled(spark, sf)[0].select("date", *SCALED_SHOWN, "spread", "spread_scaled")


@register("scale_test", f"""WITH {STEP1_CTE}
SELECT "ID", date, {qs([c for c in SCALED_SHOWN if c != 'imbalances'])} FROM test_s""")
def _(spark, sf):
    return step1_scaled(spark, sf)[1].select("ID", "date", *[c for c in SCALED_SHOWN if c != "imbalances"])


@register("scaling_summary", f"""WITH {STEP1_CTE} {' UNION ALL '.join(
    f"SELECT '{c}' AS column, {q(f'round(avg({c}), 4)', 'mean', 3)}, {q(f'round(stddev_samp({c}), 4)', 'std', 3)} FROM train_s"
    for c in STEP1_SCALED)}""", digits=3)
def _(spark, sf):
    return scaling_summary(step1_scaled(spark, sf)[0], SCALED_STEP1)


@register("target_range", f"""WITH {STEP1_CTE} SELECT {q('min(spread)', 'raw_min')}, {q('max(spread)', 'raw_max')},
  {q('min(spread_scaled)', 'scaled_min')}, {q('max(spread_scaled)', 'scaled_max')} FROM train_s""")
def _(spark, sf):
    return target_range(step1_scaled(spark, sf)[0])


@register("inverse_scale", """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice + 1e-9, 4) AS restored
FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    stats = fit_scaler(rows, ("l_extendedprice",), "l_extendedprice")
    scaled = scale_train(rows, stats, (), "l_extendedprice")
    restored = inverse_scale(scaled, stats, "l_extendedprice_scaled", "l_extendedprice", "restored")
    return restored.select("l_orderkey", "l_linenumber", "l_partkey", "restored")


@register("sign_label", """SELECT l_orderkey, l_linenumber, l_partkey,
  (l_extendedprice > 40000)::INTEGER AS actual_positive, (l_quantity * 1500 > 40000)::INTEGER AS predicted_positive,
  ((l_extendedprice > 40000) = (l_quantity * 1500 > 40000))::INTEGER AS sign_match FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumns({
        "actual": F.col("l_extendedprice") - 40000, "predicted": F.col("l_quantity") * 1500 - 40000,
    })
    return sign_label(rows).select("l_orderkey", "l_linenumber", "l_partkey", "actual_positive", "predicted_positive", "sign_match")


__all__ = ["MARKET"]
