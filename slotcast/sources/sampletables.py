"""The model's tables derived from the shared test tables (events, lineitem, orders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values -----------------------------------------------------------
SPLIT_AT = "2024-01-24 00:00:00"   # market rows before this are train, the rest test


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slot_start(ts):
    """Start of the 15-minute slot, computed without leaving local time."""
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(ts), F.floor(F.minute(ts) / 15).cast("int") * 15, F.lit(0)
    )


def market(spark: SparkSession, folder: str, keep=None) -> DataFrame:
    """One row per 15-minute slot that has events: wind, solar, load, spread, imbalances.

    Sums per slot are combined on the map side, so the shuffle carries slots,
    not events. ``keep`` filters events before that; on a slot boundary it
    selects whole slots and, unlike a filter on slots, reaches the scan.
    """
    kind, value = F.col("event_type"), F.col("value")

    def total(name):
        return F.coalesce(F.sum(F.when(kind == name, value)), F.lit(0.0))

    events = table(spark, folder, "events")
    if keep is not None:
        events = events.filter(keep)
    return (
        events.groupBy(slot_start(F.col("ts")).alias("date"))
        .agg(
            total("view").alias("wind"), total("click").alias("solar"), F.sum(value).alias("load"),
            (total("purchase") - total("signup")).alias("spread"), total("error").alias("imbalances"),
        )
    )


def market_train(spark: SparkSession, folder: str) -> DataFrame:
    slots = market(spark, folder, F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz"))
    return slots.select("date", "wind", "solar", "load", "spread")


def market_imbalances(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events").filter(F.col("event_type") == "error")
        .groupBy(slot_start(F.col("ts")).alias("date")).agg(F.sum("value").alias("imbalances"))
    )


def market_test(spark: SparkSession, folder: str) -> DataFrame:
    """Later slots with a dense ``ID`` in date order and no target."""
    from ..operators.windows import row_index

    slots = market(spark, folder, F.col("ts") >= F.lit(SPLIT_AT).cast("timestamp_ntz"))
    return row_index(slots.select("date", "wind", "solar", "load"), name="ID").select(
        "ID", "date", "wind", "solar", "load"
    )


PANEL_ORDER = ("date", "l_orderkey", "l_linenumber", "l_partkey", "value")


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Many series: extended prices per supplier in ship order; ``PANEL_ORDER`` makes the order total."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("series"), F.col("l_shipdate").alias("date"), "l_orderkey", "l_linenumber",
        "l_partkey", F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("quantity"),
    )


def event_series(spark: SparkSession, folder: str) -> DataFrame:
    """Five long series: event values per type, ordered by ``ts, event_id``."""
    return table(spark, folder, "events").select(F.col("event_type").alias("series"), "ts", "event_id", "value")


def history(spark: SparkSession, folder: str) -> DataFrame:
    """A training-history table: one run per order priority, one epoch per order month.

    Mean price of finished orders plays the training loss, that of open orders
    the validation loss. Months lacking either are left out and the rest numbered
    from 1 per run (a run has one row per calendar month at most).
    """
    from ..operators.windows import row_index

    price = F.col("o_totalprice") / 1e5
    monthly = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("run_id"), (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month_no"))
        .agg(
            F.avg(F.when(F.col("o_orderstatus") == "F", price)).alias("train_loss"),
            F.avg(F.when(F.col("o_orderstatus") == "O", price)).alias("val_loss"),
        )
        .filter("train_loss IS NOT NULL AND val_loss IS NOT NULL")
    )
    return row_index(monthly, ("run_id",), ("month_no",), name="epoch0").select(
        "run_id", (F.col("epoch0") + 1).cast("int").alias("epoch"), "train_loss", "val_loss"
    )
