"""Compare registered queries with their SQL: ``python tests/check_catalog.py [scale] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
    return df.sort_values(list(df.columns), na_position="first", kind="stable").reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    notes = []
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(set(got.columns) ^ set(want.columns))}"]
    if len(got) != len(want):
        return [f"rows {len(got)} against {len(want)}"]
    got, want = canonical(got), canonical(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if str(a.dtype) != str(b.dtype):
            notes.append(f"type {c}: {a.dtype} against {b.dtype}")
        if pd.api.types.is_float_dtype(a) or pd.api.types.is_float_dtype(b):
            x, y = a.astype(float).to_numpy(), b.astype(float).to_numpy()
            bad = ~((x == y) | (np.isnan(x) & np.isnan(y)))
        else:
            bad = ~((a == b) | (a.isna() & b.isna())).to_numpy()
        if bad.any():
            i = int(np.argmax(bad))
            notes.append(f"values {c}: {int(bad.sum())} differ, first {a.iloc[i]!r} against {b.iloc[i]!r}")
    return notes


def main():
    import __spark_entry__ as entry
    from slotcast.session import local_session

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{scale}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = local_session(8), duck(folder)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
            t1 = time.time()
            notes = compare(got, con.execute(oracles[name]).fetchdf()) if name in oracles else ["rows only"]
        except Exception as error:  # report and go on with the next query
            t1, got, notes = time.time(), [], [f"ERROR {type(error).__name__}: {str(error)[:600]}"]
        bad = [n for n in notes if n != "rows only"]
        failed += bool(bad)
        print(f"{'BAD ' if bad else 'ok  '} {name:28s} {len(got):7d} rows {t1 - t0:6.2f}s {'; '.join(notes)[:700]}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
