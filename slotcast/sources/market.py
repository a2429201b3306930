"""Market tables from CSV (or parquet) files with fixed schemas, and prepared tables read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.domain import nan_to_null
from ..schema import (
    DATE, FEATURES, IMBALANCES_SCHEMA, SAMPLE_SCHEMA, TARGET_SCALED, TEST_SCHEMA, TRAIN_SCHEMA, present,
)

# --- fixed values: file name of each table ----------------------------------
FILES = {"train": "train", "imbalances": "imbalances", "test": "test", "sample": "sample"}
SCHEMAS = {
    "train": TRAIN_SCHEMA, "imbalances": IMBALANCES_SCHEMA, "test": TEST_SCHEMA, "sample": SAMPLE_SCHEMA,
}


def load_market(spark: SparkSession, folder: str, kind: str = "csv") -> dict[str, DataFrame]:
    """The four tables as lazy DataFrames. No schema inference; NaN becomes NULL on the way in.

    CSV columns are matched to the schema by header name, so their order in the
    file does not matter.
    """
    tables = {}
    for name, stem in FILES.items():
        path = f"{folder.rstrip('/')}/{stem}.{kind}"
        if kind == "csv":
            df = _read_csv(spark, path, SCHEMAS[name])
        else:
            df = spark.read.format(kind).load(path)
        tables[name] = nan_to_null(df)
    return tables


def _read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)  # every field a string: only the header line is read here
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


REJECTED = "source string, column string, value string, reason string"
_BAD = "__bad_line"


def load_market_checked(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four CSV tables without their faulty rows, and a table of the faults: source, column, value, reason.

    A row is faulty if its number of fields is not the header's (reason ``fields``, the whole line as value), if a field
    isn't of its column's type (reason: the type; empty fields and NaN are missing, not faulty), or if its key (``date``,
    or ``ID`` where there is no date) is missing (reason ``missing``). A row with several faults has several rows there.
    Files without rows give empty tables; a missing column is an error, further columns are not read.
    """
    tables, faults = {}, spark.createDataFrame([], REJECTED)
    for name, stem in FILES.items():
        rows = _checked(spark, f"{folder.rstrip('/')}/{stem}.csv", SCHEMAS[name])
        tables[name] = nan_to_null(rows.filter(F.size("__faults") == 0).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in SCHEMAS[name]]))
        faults = faults.unionByName(rows.select(F.lit(name).alias("source"), F.inline("__faults")))
    return tables, faults


def _checked(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a CSV file as text, with their faults. All columns are parsed: fields are counted over them."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _BAD)])
    raw = spark.read.schema(text).option("header", True).option("columnPruning", False).option("columnNameOfCorruptRecord", _BAD).csv(path)
    fault = lambda column, value, reason: F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason"))
    whole, key = F.col(_BAD).isNull(), DATE if DATE in schema.names else schema.names[0]
    found = [F.when(~whole, fault(None, F.col(_BAD), "fields"))]
    for f in schema:
        field = F.trim(F.col(f"`{f.name}`"))
        given = field.isNotNull() & (field != "") & (F.lower(field) != "nan")
        found.append(F.when(whole & given & field.try_cast(f.dataType).isNull(), fault(f.name, field, f.dataType.simpleString())))
        if f.name == key:
            found.append(F.when(whole & ~F.coalesce(given, F.lit(False)), fault(f.name, field, "missing")))
    return raw.withColumn("__faults", F.array_compact(F.array(*found)))


def load_prepared(df: DataFrame, features=FEATURES, target: str = TARGET_SCALED, ts: str = DATE) -> DataFrame:
    """``date, features, target``: the feature vector and target as 32-bit floats."""
    return df.select(ts, _vector(df, features), F.col(target).cast("float").alias("target"))


def load_test(df: DataFrame, features=FEATURES, ts: str = DATE) -> DataFrame:
    """``ID, date, features`` of the prepared test table."""
    return df.select("ID", ts, _vector(df, features))


def _vector(df: DataFrame, features):
    missing = [c for c in features if c not in present(df, features)]
    if missing:
        raise ValueError(f"prepared table lacks {', '.join(missing)}")
    return F.array(*[F.col(c).cast("float") for c in features]).alias("features")
