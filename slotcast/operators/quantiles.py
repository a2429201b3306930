"""Exact, linearly interpolated quantiles without gathering a column in one task.

Spark's ``percentile`` keeps every distinct value in one buffer. That is fine up
to ``SMALL`` rows. Beyond, the interval around each wanted rank is narrowed by
counting rows in ``BINS`` equal parts of it - a map-side combined count with at
most BINS output rows per rank - until few rows are left inside.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

SMALL = 1_000_000
BINS = 4096
# Rows of an interval table (under 100 bytes each) that are broadcast; more are joined by shuffle.
BROADCAST_INTERVALS = 200_000
# Values that are sorted in one place at the end.
GATHERED = 16_384


def exact_quantiles(df: DataFrame, column: str, probs, small: int = SMALL, bins: int = BINS) -> list[float | None]:
    """Quantiles of the non-NULL values of one column, as numbers."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    n, lo, hi = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(probs)
    if n <= small:
        return list(values.agg(F.percentile("v", F.array(*[F.lit(float(p)) for p in probs]))).first()[0])
    ranks = sorted({r for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))})
    found = _order_statistics(values, ranks, lo, hi, n, small, bins)
    out = []
    for p in probs:
        h = (n - 1) * p
        a, b = found[math.floor(h)], found[math.ceil(h)]
        out.append(a + (b - a) * (h - math.floor(h)))
    return out


def _order_statistics(values: DataFrame, ranks, lo, hi, n, small, bins) -> dict[int, float]:
    """The value at each 0-based rank, narrowing all ranks' intervals in shared passes."""
    # interval [lo, hi] holding `inside` rows, with `below` rows under it
    state = {r: (lo, hi, 0, n) for r in ranks}
    while True:
        wide = sorted({s for s in state.values() if s[3] > small and s[0] < s[1]})
        if not wide:
            break
        counts = {}
        parts = []
        for i, (a, b, _, _) in enumerate(wide):
            # part number is only a label: the exact ends come from min and max below
            part = F.least(F.floor((F.col("v") / 2 - a / 2) / (b / 2 - a / 2) * bins), F.lit(bins - 1))
            parts.append(F.when(F.col("v").between(a, b), F.struct(F.lit(i).alias("i"), part.alias("part"))))
        rows = (
            values.select("v", F.explode(F.array_compact(F.array(*parts))).alias("s"))
            .groupBy("s.i", "s.part").agg(F.count("v").alias("c"), F.min("v").alias("a"), F.max("v").alias("b"))
            .collect()
        )
        for row in rows:
            counts.setdefault(row["i"], []).append((row["a"], row["b"], row["c"]))
        for r, s in list(state.items()):
            if s not in wide:
                continue
            below = s[2]
            for a, b, c in sorted(counts[wide.index(s)]):
                if r < below + c:
                    state[r] = (a, b, below, c)
                    break
                below += c
    found = {r: s[0] for r, s in state.items() if s[0] == s[1]}
    for s in sorted({s for s in state.values() if s[0] < s[1]}):
        a, b, below, inside = s
        mine = [r for r in ranks if state[r] == s]
        at = [0.0 if inside == 1 else (r - below) / (inside - 1) for r in mine]
        got = values.filter(F.col("v").between(a, b)).agg(
            F.percentile("v", F.array(*[F.lit(p) for p in at]))
        ).first()[0]
        found.update(zip(mine, got))
    return found


def quantile_table(df: DataFrame, column: str, probs, names, series=(), small: int = SMALL, bins: int = BINS) -> DataFrame:
    """Quantiles per series. Series up to ``small`` rows share one aggregate; all larger ones are narrowed together.

    Each wanted rank of a large series has an interval of values, a row of a small table. A pass joins the values to the
    intervals of their series, counts them in ``bins`` parts and keeps the part that holds the rank. Passes end when no
    interval holds more than ``GATHERED`` rows, which one aggregate sorts. The plan of a pass doesn't depend on how many
    series there are.
    """
    spark = df.sparkSession
    if not series:
        return spark.createDataFrame(
            [tuple(exact_quantiles(df, column, probs, small, bins))], ", ".join(f"{n} double" for n in names)
        )
    keys = list(series)
    values = df.select(*keys, F.col(column).cast("double").alias("v"))
    sized = materialize(values.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    large = sized.filter(F.col("n") > small)
    count = large.count()
    if not count:
        found = values.groupBy(*keys).agg(F.percentile("v", wanted).alias("q"))
    else:
        few = _per_series(values, sized.filter(F.col("n") <= small).select(*keys), keys, sized.count() - count)
        found = few.groupBy(*keys).agg(F.percentile("v", wanted).alias("q")).unionByName(_narrowed(values, large, keys, count, probs, small, bins))
    return found.select(*keys, *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def _per_series(left: DataFrame, right: DataFrame, keys, count: int, extra=None) -> DataFrame:
    """Joins on equal keys, missing ones too; broadcast only what was counted and is small."""
    right = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = extra
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        cond = eq if cond is None else cond & eq
    return left.join(F.broadcast(right) if count <= BROADCAST_INTERVALS else right, cond).drop(*[f"__k_{k}" for k in keys])


def _narrowed(values: DataFrame, large: DataFrame, keys, count: int, probs, small: int, bins: int) -> DataFrame:
    """Rows (keys, q) of the large series."""
    at = [(F.col("n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(h).cast("long") for h in at for f in (F.floor, F.ceil)]))
    state = materialize(large.select(*keys, "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), F.explode(ranks).alias("rank")))
    open_ = (F.col("inside") > min(small, GATHERED)) & (F.col("lo") < F.col("hi"))
    most = count * 2 * len(probs)
    while state.filter(open_).limit(1).count():
        wide = state.filter(open_)
        spans = wide.select(*keys, "lo", "hi", "below").distinct()
        hits = _per_series(values, spans, keys, most, F.col("v").between(F.col("lo"), F.col("hi")))
        # part number is only a label: the exact ends come from min and max below
        part = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins), F.lit(bins - 1))
        parts = hits.groupBy(*keys, "lo", "hi", "below", part.alias("part")).agg(F.count("v").alias("c"), F.min("v").alias("a"), F.max("v").alias("b"))
        along = Window.partitionBy(*keys, "lo", "hi").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("under", F.col("below") + F.coalesce(F.sum("c").over(along), F.lit(0)))
        parts = parts.select(*keys, F.col("lo").alias("was_lo"), F.col("hi").alias("was_hi"), "a", "b", "c", "under")
        chosen = _per_series(
            wide, parts, keys, most * bins,
            (F.col("lo") == F.col("was_lo")) & (F.col("hi") == F.col("was_hi")) & (F.col("rank") >= F.col("under")) & (F.col("rank") < F.col("under") + F.col("c")),
        )
        moved = chosen.select(*keys, F.col("a").alias("lo"), F.col("b").alias("hi"), F.col("under").alias("below"), F.col("c").alias("inside"), "rank")
        state = materialize(state.filter(~open_).unionByName(moved))
    exact = state.filter("lo = hi").select(*keys, "rank", F.col("lo").alias("value"))
    rest = state.filter("lo < hi").groupBy(*keys, "lo", "hi", "below").agg(F.sort_array(F.collect_set("rank")).alias("ranks"))
    inside = _per_series(values, rest, keys, most, F.col("v").between(F.col("lo"), F.col("hi")))
    listed = inside.groupBy(*keys, "ranks", "below").agg(F.sort_array(F.collect_list("v")).alias("vs"))
    picked = listed.select(*keys, F.explode("ranks").alias("rank"), "below", "vs").select(*keys, "rank", F.element_at("vs", (F.col("rank") - F.col("below") + 1).cast("int")).alias("value"))
    found = exact.unionByName(picked)
    table = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("m"))
    joined = _per_series(large.select(*keys, "n"), table, keys, count)
    q = []
    for h in at:
        a, b = F.element_at("m", F.floor(h).cast("long")), F.element_at("m", F.ceil(h).cast("long"))
        q.append(a + (b - a) * (h - F.floor(h)))
    return joined.select(*keys, F.array(*q).alias("q"))
