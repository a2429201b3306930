"""SQL for the tables derived from the shared test data, and their loading queries."""

from __future__ import annotations

import uuid

from slotcast.operators.grid import merge_imbalances, regular_grid, sort_by_date
from slotcast.operators.quality import data_summary
from slotcast.operators.scaling import fit_scaler, scale_test, scale_train
from slotcast.plans.prepare import step1_features
from slotcast.schema import CORE, DOMAIN, SCALED_STEP1, TEMPORAL
from slotcast.session import ensure_checkpoint_dir
from slotcast.sources.market import load_market, load_market_checked, load_prepared as read_vectors, load_test as read_test_vectors
from slotcast.sources.sampletables import event_series, market, market_imbalances, market_test, market_train, panel
from slotcast.sources.sinks import submission
from pyspark.sql import functions as F

from . import q, qs, register

MARKET = """market AS (
  SELECT time_bucket(INTERVAL '15 minutes', ts) AS date,
    coalesce(sum(value) FILTER (WHERE event_type = 'view'), 0) AS wind,
    coalesce(sum(value) FILTER (WHERE event_type = 'click'), 0) AS solar,
    sum(value) AS load,
    coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0)
      - coalesce(sum(value) FILTER (WHERE event_type = 'signup'), 0) AS spread,
    coalesce(sum(value) FILTER (WHERE event_type = 'error'), 0) AS imbalances
  FROM events GROUP BY 1)"""
TRAIN = MARKET + """,
train AS (SELECT date, wind, solar, load, spread FROM market WHERE date < TIMESTAMP '2024-01-24 00:00:00')"""
IMB = """imb AS (
  SELECT time_bucket(INTERVAL '15 minutes', ts) AS date, sum(value) AS imbalances
  FROM events WHERE event_type = 'error' GROUP BY 1)"""
TEST = """test AS (
  SELECT row_number() OVER (ORDER BY date) - 1 AS "ID", date, wind, solar, load
  FROM market WHERE date >= TIMESTAMP '2024-01-24 00:00:00')"""
MERGED = TRAIN + ",\n" + IMB + """,
merged AS (SELECT t.*, i.imbalances FROM train t LEFT JOIN imb i ON t.date = i.date)"""
PANEL = """panel AS (
  SELECT l_suppkey AS series, l_shipdate AS date, l_orderkey, l_linenumber, l_partkey,
    l_extendedprice AS value, l_quantity AS quantity FROM lineitem)"""
EVENTS = "es AS (SELECT event_type AS series, ts, event_id, value FROM events)"

DOW = "(isodow(date) - 1)"
SLOT = "(hour(date) * 4 + minute(date) // 15)"
PARTS = f"""hour(date)::INTEGER AS hour, minute(date)::INTEGER AS minute, {DOW}::INTEGER AS day_of_week,
  month(date)::INTEGER AS month, dayofyear(date)::INTEGER AS day_of_year, quarter(date)::INTEGER AS quarter,
  {SLOT}::INTEGER AS interval_of_day, ({DOW} >= 5)::INTEGER AS is_weekend"""
CYCLES = {
    "hour": ("hour(date)", 24), "month": ("(month(date) - 1)", 12), "dow": (DOW, 7), "interval": (SLOT, 96),
}
WAVES = {
    f"{name}_{fn}": f"{fn}(2 * pi() * {pos} / {period}.0)"
    for name, (pos, period) in CYCLES.items() for fn in ("sin", "cos")
}
DOMAIN_SQL = {
    "net_load": "load - wind - solar",
    "renewable_ratio": "coalesce((wind + solar) / nullif(load, 0), 0)",
    "wind_solar_ratio": "wind / (solar + 1)",
    "total_renewable": "wind + solar",
}


def step1_sql(source: str) -> str:
    """Calendar and domain columns added to a table."""
    waves = ", ".join(f"{e} AS {n}" for n, e in WAVES.items())
    domain = ", ".join(f"{e} AS {n}" for n, e in DOMAIN_SQL.items())
    return f"SELECT *, {PARTS}, {waves}, {domain} FROM {source}"


def _written(spark, sf, spoil=lambda df: df) -> str:
    """The market tables as CSV files in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/market-{uuid.uuid4().hex}"
    sample = market_test(spark, sf).select("ID", F.lit(0.5).alias("forecast"))
    for name, df in (("train", market_train(spark, sf)), ("imbalances", market_imbalances(spark, sf)), ("test", market_test(spark, sf)), ("sample", sample)):
        # wind in scientific notation and columns out of order are read as well
        text = df.select(*[F.col(c).cast("string").alias(c) for c in reversed(df.columns)])
        (spoil(text) if name == "train" else text).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


@register("load_market", f"WITH {TRAIN} SELECT date, {qs(['wind', 'solar', 'load', 'spread'])} FROM train")
def _(spark, sf):
    return load_market(spark, _written(spark, sf))["train"]


def _spoiled(df):
    """Some dates that are none, some words for numbers, some missing keys and values."""
    hour, minute = F.substring("date", 12, 2), F.substring("date", 15, 2)
    return df.withColumns({
        "wind": F.when(hour == "04", F.lit("calm")).when(hour == "05", F.lit("NaN")).otherwise(F.col("wind")),
        "load": F.when(hour == "06", F.lit(None)).when((hour == "04") & (minute == "15"), F.lit("1,5")).otherwise(F.col("load")),
        "date": F.when((hour == "07") & (minute == "30"), F.lit("2024-13-45")).when(hour == "08", F.lit(None)).otherwise(F.col("date")),
    })


@register("load_market_rejected", f"""WITH {TRAIN}
SELECT 'train' AS source, 'wind' AS column, 'calm' AS value, 'double' AS reason, count(*) AS rows FROM train WHERE hour(date) = 4 HAVING count(*) > 0
UNION ALL SELECT 'train', 'load', '1,5', 'double', count(*) FROM train WHERE hour(date) = 4 AND minute(date) = 15 HAVING count(*) > 0
UNION ALL SELECT 'train', 'date', '2024-13-45', 'timestamp_ntz', count(*) FROM train WHERE hour(date) = 7 AND minute(date) = 30 HAVING count(*) > 0
UNION ALL SELECT 'train', 'date', NULL, 'missing', count(*) FROM train WHERE hour(date) = 8 HAVING count(*) > 0
UNION ALL SELECT 'kept', NULL, NULL, NULL, count(*) FROM train WHERE hour(date) NOT IN (4, 8) AND NOT (hour(date) = 7 AND minute(date) = 30)""")
def _(spark, sf):
    tables, faults = load_market_checked(spark, _written(spark, sf, _spoiled))
    none = [F.lit(None).cast("string").alias(c) for c in ("column", "value", "reason")]
    kept = tables["train"].select(F.lit("kept").alias("source"), *none)
    return faults.unionByName(kept).groupBy("source", "column", "value", "reason").agg(F.count("*").alias("rows"))


@register("load_market_test", f"""WITH {MARKET}, {TEST}
SELECT "ID", date, {qs(['wind', 'solar', 'load'])} FROM test""")
def _(spark, sf):
    return market_test(spark, sf)


STEP1_SCALED = list(SCALED_STEP1)
VECTOR = [*CORE, *TEMPORAL, *DOMAIN]


def _scale_sql(columns, source, stats="train1"):
    return ", ".join(
        f"({c} - (SELECT avg({c}) FROM {stats})) / (SELECT stddev_pop({c}) FROM {stats}) AS {c}" for c in columns
    )


STEP1_CTE = f"""{MERGED}, {TEST}, train1 AS ({step1_sql('merged')}), test1 AS ({step1_sql('test')}),
train_s AS (SELECT * REPLACE ({_scale_sql(STEP1_SCALED, 'train1')}),
  (spread - (SELECT avg(spread) FROM train1)) / (SELECT stddev_pop(spread) FROM train1) AS spread_scaled FROM train1),
test_s AS (SELECT * REPLACE ({_scale_sql([c for c in STEP1_SCALED if c != 'imbalances'], 'test1')}) FROM test1)"""


def step1_tables(spark, sf):
    train = step1_features(merge_imbalances(market_train(spark, sf), market_imbalances(spark, sf)))
    return train, step1_features(market_test(spark, sf))


def step1_scaled(spark, sf):
    train, test = step1_tables(spark, sf)
    scaler = fit_scaler(train, SCALED_STEP1)
    return scale_train(train, scaler, SCALED_STEP1), scale_test(test, scaler, SCALED_STEP1), scaler


@register("load_prepared", f"""WITH {STEP1_CTE}
SELECT date, {', '.join(q(f'{c}::FLOAT', f'f_{i}', 3) for i, c in enumerate(VECTOR))},
  {q('spread_scaled::FLOAT', 'target', 3)} FROM train_s""", digits=3)
def _(spark, sf):
    vectors = read_vectors(step1_scaled(spark, sf)[0], VECTOR)
    return vectors.select("date", *[F.col("features")[i].alias(f"f_{i}") for i in range(len(VECTOR))], "target")


@register("load_test", f"""WITH {STEP1_CTE}
SELECT "ID", date, {', '.join(q(f'{c}::FLOAT', f'f_{i}', 3) for i, c in enumerate(VECTOR))} FROM test_s""", digits=3)
def _(spark, sf):
    vectors = read_test_vectors(step1_scaled(spark, sf)[1], VECTOR)
    return vectors.select("ID", "date", *[F.col("features")[i].alias(f"f_{i}") for i in range(len(VECTOR))])


GRID = """spine AS (
  SELECT unnest(generate_series((SELECT min(date) FROM {t}), (SELECT max(date) FROM {t}), INTERVAL '15 minutes')) AS date)"""


@register("regular_grid", f"""WITH {TRAIN}, {GRID.format(t='train')}
SELECT s.date, {', '.join(q('t.' + c, c) for c in ('wind', 'solar', 'load', 'spread'))}
FROM spine s LEFT JOIN train t ON s.date = t.date""")
def _(spark, sf):
    return regular_grid(market_train(spark, sf))


@register("regular_grid_test", f"""WITH {MARKET}, {TEST}, {GRID.format(t='test')}
SELECT t."ID"::DOUBLE AS "ID", s.date, {', '.join(q('t.' + c, c) for c in ('wind', 'solar', 'load'))}
FROM spine s LEFT JOIN test t ON s.date = t.date""")
def _(spark, sf):
    # shown as double: slots the grid adds have no ID
    return regular_grid(market_test(spark, sf)).withColumn("ID", F.col("ID").cast("double"))


@register("regular_grid_series", """WITH slots AS (
  SELECT event_type AS series, time_bucket(INTERVAL '15 minutes', ts) AS date, sum(value) AS value
  FROM events GROUP BY 1, 2),
ends AS (SELECT series, min(date) AS lo, max(date) AS hi FROM slots GROUP BY 1),
spine AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL '15 minutes')) AS date FROM ends)
SELECT s.series, s.date, round(t.value + 1e-9, 4) AS value
FROM spine s LEFT JOIN slots t ON s.series = t.series AND s.date = t.date""")
def _(spark, sf):
    from slotcast.sources.sampletables import slot_start

    slots = event_series(spark, sf).groupBy("series", slot_start(F.col("ts")).alias("date")).agg(F.sum("value").alias("value"))
    return regular_grid(slots, ("series",))


@register("submission", f"""WITH {MARKET}, {TEST}
SELECT "ID", {q('1 / (1 + exp(-(wind - solar) / 50.0))', 'forecast', 6)} FROM test""", digits=6)
def _(spark, sf):
    forecast = market_test(spark, sf).withColumn("probability", 1 / (1 + F.exp(-(F.col("wind") - F.col("solar")) / 50.0)))
    return submission(forecast)


@register("merge_imbalances", f"""WITH {MERGED}
SELECT date, {qs(['wind', 'solar', 'load', 'spread', 'imbalances'])} FROM merged""")
def _(spark, sf):
    return merge_imbalances(market_train(spark, sf), market_imbalances(spark, sf))


@register("data_summary", f"""WITH {MERGED}, {TEST}
SELECT 'train' AS table_name, count(*) AS rows, 6::BIGINT AS columns, min(date) AS first_date, max(date) AS last_date,
  u.column_name, max(u.missing)::BIGINT AS missing
FROM merged, (
  SELECT 'date' AS column_name, count(*) - count(date) AS missing FROM merged UNION ALL
  SELECT 'wind', count(*) - count(wind) FROM merged UNION ALL
  SELECT 'solar', count(*) - count(solar) FROM merged UNION ALL
  SELECT 'load', count(*) - count(load) FROM merged UNION ALL
  SELECT 'spread', count(*) - count(spread) FROM merged UNION ALL
  SELECT 'imbalances', count(*) - count(imbalances) FROM merged) u
GROUP BY u.column_name
UNION ALL
SELECT 'test', count(*), 5::BIGINT, min(date), max(date), u.column_name, 0::BIGINT
FROM test, (SELECT unnest(['ID', 'date', 'wind', 'solar', 'load']) AS column_name) u GROUP BY u.column_name""")
def _(spark, sf):
    train = merge_imbalances(market_train(spark, sf), market_imbalances(spark, sf))
    return data_summary({"train": train, "test": market_test(spark, sf)})


@register("sort_by_date", f"WITH {PANEL} SELECT date, series, l_orderkey, l_linenumber, l_partkey, {q('value')} FROM panel ORDER BY date")
def _(spark, sf):
    ties = ("series", "l_orderkey", "l_linenumber", "l_partkey", "value")
    return sort_by_date(panel(spark, sf), ties).select("date", *ties[:4], "value")


__all__ = ["market"]
