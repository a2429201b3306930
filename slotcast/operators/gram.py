"""Cross-product sums over many columns in one pass.

A thousand pairwise sums as SQL aggregates is a plan nobody wants to compile.
Here each task multiplies its Arrow batches as matrices and returns the sums
of its rows (one small table per task); Spark adds those up by pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# groups held per task before their partial sums are handed on
HELD_GROUPS = 64
# up to this many columns the pairs (36 at most) are plain aggregates
PLAIN_COLUMNS = 8


def gram(df: DataFrame, columns, group=()) -> DataFrame:
    """Sums of x_i * x_j over complete rows: ``group..., i, j, g`` for i <= j."""
    columns, group = list(columns), list(group)
    k = len(columns)
    upper_i, upper_j = np.triu_indices(k)
    data = df.select(*group, *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(columns)])
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema if f.name in group]
        + ["i int", "j int", "g double"]
    )

    def rows(held):
        for key, m in held.items():
            out = pd.DataFrame({"i": upper_i, "j": upper_j, "g": m[upper_i, upper_j]})
            for name, value in zip(group, key):
                # a missing key comes as NaN, whatever the column's type
                out[name] = pd.Series([None if pd.isna(value) else value] * len(out), dtype=object)
            yield out[[*group, "i", "j", "g"]]

    def partial(batches):
        held = {}
        for pdf in batches:
            x = pdf.iloc[:, len(group):].to_numpy(dtype=float)
            # incomplete rows are left out here: as a filter over dozens of derived
            # columns they would make the planner infer constraints without end
            whole = ~np.isnan(x).any(axis=1)
            x, pdf = x[whole], pdf[whole]
            if group:
                codes = pdf.groupby(group, sort=False, dropna=False).indices
                parts = ((key if isinstance(key, tuple) else (key,), x[at]) for key, at in codes.items())
            else:
                parts = (((), x),)
            for key, block in parts:
                m = block.T @ block
                held[key] = held[key] + m if key in held else m
            if len(held) > HELD_GROUPS:
                yield from rows(held)
                held = {}
        yield from rows(held)

    sums = data.mapInPandas(partial, schema)
    return sums.groupBy(*group, "i", "j").agg(F.sum("g").alias("g"))


def gram_arrays(df: DataFrame, columns, group) -> DataFrame:
    """``gram`` as one row per group: ``group..., g`` with the upper triangle row by row."""
    columns, group = list(columns), list(group)
    if len(columns) > PLAIN_COLUMNS:
        sums = gram(df, columns, group)
        packed = sums.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("i", "j", "g"))).alias("g"))
        return packed.select(*group, F.col("g.g").alias("g"))
    names = [f"__x{i}" for i in range(len(columns))]
    data = df.select(*group, *[F.col(c).cast("double").alias(x) for c, x in zip(columns, names)])
    for x in names:
        data = data.filter(F.col(x).isNotNull() & ~F.isnan(x))
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return data.groupBy(*group).agg(*[s.alias(f"__g{n}") for n, s in enumerate(products)]).select(
        *group, F.array(*[f"__g{n}" for n in range(len(products))]).alias("g")
    )


def to_matrix(rows, k: int) -> np.ndarray:
    """(i, j, g) rows of one group as a symmetric matrix."""
    m = np.zeros((k, k))
    for i, j, g in rows:
        m[i, j] = m[j, i] = g
    return m


def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """Pairwise-complete Pearson correlation as a long table ``x, y, r`` with both orders and the diagonal."""
    columns = [c for c in columns if c in df.columns]
    k = len(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    # centred columns keep the sums of squares from cancelling
    data = df.select(*[
        (F.col(c).cast("double") - F.lit(means[c] if means[c] is not None else 0.0)).alias(f"x{i}")
        for i, c in enumerate(columns)
    ])
    upper_i, upper_j = np.triu_indices(k)

    def partial(batches):
        total = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            m = ~np.isnan(x)
            x = np.where(m, x, 0.0)
            mf = m.astype(float)
            s = x.T @ mf            # [a, b]: sum of a where b is present
            q = (x * x).T @ mf
            part = np.stack([mf.T @ mf, s, s.T, q, q.T, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            out = pd.DataFrame(total[:, upper_i, upper_j].T, columns=["n", "sx", "sy", "sxx", "syy", "sxy"])
            out.insert(0, "i", upper_i)
            out.insert(1, "j", upper_j)
            yield out

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    sums = data.mapInPandas(partial, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    sums = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    # rounding leaves a constant column a tiny variance; it has no correlation
    flat = (vx <= F.col("n") * F.col("sxx") * 1e-13) | (vy <= F.col("n") * F.col("syy") * 1e-13)
    r = F.when(~flat & (F.col("n") > 1), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(vx * vy))))
    label = F.array(*[F.lit(c) for c in columns])
    half = sums.select(label[F.col("i")].alias("x"), label[F.col("j")].alias("y"), r.alias("r"), (F.col("i") == F.col("j")).alias("d"))
    both = F.when(F.col("d"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    )
    return half.select(F.inline(both), "r")
