"""Checked loading and versioned tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slotcast import load_market_checked, read_versioned, versions, write_cv, write_versioned
from slotcast.schema import SAMPLE_SCHEMA, TEST_SCHEMA, TRAIN_SCHEMA


def write(folder, **files):
    defaults = {
        "train": "date,wind,solar,load,spread\n", "imbalances": "date,imbalances\n", "test": "ID,date,wind,solar,load\n", "sample": "ID,forecast\n",
    }
    for name, head in defaults.items():
        (folder / f"{name}.csv").write_text(files.get(name, head))


def test_faulty_rows_are_told_apart(spark, tmp_path):
    write(
        tmp_path,
        train="spread,date,extra,wind,solar,load\n"
              "1.5,2024-01-01 00:00:00,x,1,2,3\n"
              "NaN,2024-01-01 00:15:00,,1e3,,3\n"          # missing values are no fault
              "1,2024-02-30 00:00:00,x,1,2,3\n"            # no such day
              "1,,x,1,2,3\n"                               # no key
              "one,2024-01-01 00:30:00,x,1,two,3\n"        # two faults
              "1,2024-01-01 00:45:00,x\n"                  # too few fields
              "1,2024-01-01 01:00:00,x,1,2,3,4\n",         # too many
        test="ID,date,wind,solar,load\n7,2024-01-02 00:00:00,1,2,3\n7.5,2024-01-02 00:15:00,1,2,3\n",
        sample="ID,forecast\n1,0.5\n,0.5\n",
    )
    tables, faults = load_market_checked(spark, str(tmp_path))
    assert tables["train"].schema == TRAIN_SCHEMA and tables["test"].schema == TEST_SCHEMA and tables["sample"].schema == SAMPLE_SCHEMA
    got = tables["train"].orderBy("date").collect()
    assert [(r["wind"], r["solar"], r["spread"]) for r in got] == [(1.0, 2.0, 1.5), (1000.0, None, None)]
    assert sorted(map(tuple, faults.fillna("").collect())) == sorted([
        ("train", "date", "2024-02-30 00:00:00", "timestamp_ntz"), ("train", "date", "", "missing"), ("train", "spread", "one", "double"),
        ("train", "solar", "two", "double"), ("train", "", "1,2024-01-01 00:45:00,x", "fields"), ("train", "", "1,2024-01-01 01:00:00,x,1,2,3,4", "fields"),
        ("test", "ID", "7.5", "bigint"), ("sample", "ID", "", "missing"),
    ])
    assert {k: t.count() for k, t in tables.items()} == {"train": 2, "imbalances": 0, "test": 1, "sample": 1}


def test_missing_column_is_an_error(spark, tmp_path):
    write(tmp_path, train="date,wind,solar,load\n")
    with pytest.raises(ValueError, match="spread"):
        load_market_checked(spark, str(tmp_path))


def test_failed_write_leaves_the_version_before(spark, tmp_path):
    path = f"{tmp_path}/table"
    first = write_versioned(spark.range(5), path)
    with pytest.raises(PySparkException):
        write_versioned(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), path)
    assert read_versioned(spark, path).count() == 5 and versions(spark, path).count() == 1
    reader = read_versioned(spark, path)
    second = write_versioned(spark.range(7), path)
    assert read_versioned(spark, path).count() == 7 and read_versioned(spark, path, first).count() == 5
    assert reader.count() == 5  # a reader of the version before isn't disturbed
    assert {r["version"] for r in versions(spark, path).collect()} == {first, second}


def test_fold_table_keeps_its_columns(spark, tmp_path):
    row = dict(fold_id=1, train_start="a", train_end="b", val_start="c", val_end="d", train_rows=1, val_rows=2, scored_rows=2, train_loss=0.1, val_loss=0.2, val_mae=0.3, val_rmse=0.4, val_r2=0.5, overfit_gap=0.1)
    write_cv(spark.createDataFrame([row]), f"{tmp_path}/cv")
    got = read_versioned(spark, f"{tmp_path}/cv")
    assert got.columns == ["fold_id", "train_start", "train_end", "val_start", "val_end", "train_rows", "val_rows", "best_epoch", "val_mae", "val_rmse", "val_r2", "overfit_gap"]
    assert got.first()["best_epoch"] is None
