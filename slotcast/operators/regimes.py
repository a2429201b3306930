"""K-means market regimes.

The model asks for 10 starts for each of 9 cluster counts. Run one after the
other that is 90 fits, each reading the table once per iteration. Here all
starts advance together: one pass assigns every row under every unfinished
model and returns per-task sums, so the table is read once per iteration for
the whole set. About a thousand cells with their row counts stand for the table
between passes: starts settle on them, and after each pass they settle on them
again, shifted by what the table's step said otherwise, so few passes are left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..schema import (
    CORE, ELBOW_RANGE, REGIME_INITS, REGIME_MAX_ITER, REGIME_SEED, REGIMES, TARGET, regime_columns,
)

# Cells that stand for the table while starts settle: about so many are drawn per round, and rounds.
CELLS_PER_ROUND, CELL_ROUNDS = 256, 4
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Regimes:
    columns: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    inertia: float

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """``regime`` and one column per coordinate."""
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centres)]
        return spark.createDataFrame(rows, ", ".join(["regime int", *(f"`{c}` double" for c in self.columns)]))

    @classmethod
    def from_frame(cls, frame: DataFrame, inertia: float = float("nan")) -> "Regimes":
        rows = sorted(frame.collect(), key=lambda r: r["regime"])
        columns = tuple(c for c in frame.columns if c != "regime")
        return cls(columns, tuple(tuple(r[c] for c in columns) for r in rows), inertia)


def _spread_starts(x: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Distance-weighted starting centres from a small array of weighted points."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.choice(len(x), p=weight / weight.sum())]]
    near = weight * ((x - centres[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = near.sum()
        pick = rng.choice(len(x), p=near / total) if total > 0 else rng.integers(len(x))
        centres.append(x[pick])
        near = np.minimum(near, weight * ((x - x[pick]) ** 2).sum(1))
    return _settle(x, weight, np.array(centres))


def _step(x: np.ndarray, weight: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Means of the weighted points nearest to each centre; a centre without points stays."""
    label = ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
    count = np.bincount(label, weights=weight, minlength=len(centres))
    sums = np.stack([np.bincount(label, weights=weight * x[:, d], minlength=len(centres)) for d in range(x.shape[1])], 1)
    return np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)


def _settle(x: np.ndarray, weight: np.ndarray, centres: np.ndarray, shift=0.0, rounds: int = 300) -> np.ndarray:
    """Moves centres to rest on the small array, so that the full table needs few passes.

    ``shift`` is what a step of the full table adds to one of the array. Where the shifted steps rest, the table's own
    steps rest too, if the shift is still the same there.
    """
    for _ in range(rounds):
        new = _step(x, weight, centres) + shift
        if np.allclose(new, centres):
            break
        centres = new
    return centres


def _cells(points: DataFrame, columns) -> tuple[np.ndarray, np.ndarray]:
    """Means and row counts of about a thousand cells that cover all rows.

    Cells form around rows drawn by distance: in a round each row has a chance in proportion to its squared distance from
    those drawn so far. The draw is a hash of the row's coordinates and the round, so it is the same however the table is
    partitioned. A round only measures distances to what the round before drew.
    """
    first = points.orderBy(F.xxhash64(*columns, F.lit(-1)), *columns).limit(1).toPandas().to_numpy(dtype=float)
    found, new = first, first
    state = points.withColumn("near", F.lit(float("inf")))
    schema = ", ".join([f"`{c}` double" for c in columns] + ["near double"])
    for number in range(CELL_ROUNDS):
        last, state = state, _nearer(state, new, schema)
        state.persist(StorageLevel.MEMORY_AND_DISK)
        total = state.agg(F.sum("near")).first()[0]
        last.unpersist()
        if not total:
            break
        chance = F.xxhash64(*columns, F.lit(number)).cast("double") / F.lit(2.0 ** 64) + 0.5
        drawn = state.filter(chance < F.col("near") * (CELLS_PER_ROUND / total)).select(*columns).distinct()
        new = drawn.orderBy(*columns).toPandas().to_numpy(dtype=float)
        found = np.unique(np.concatenate([found, new]), axis=0)
    state.unpersist()
    sums = _pass(points, {0: found}, len(columns)).get(0, {})
    held = [v for _, v in sorted(sums.items()) if v[0]]
    return np.array([np.array(total) / n for n, _, total in held]), np.array([n for n, _, _ in held], dtype=float)


def _nearer(state: DataFrame, new: np.ndarray, schema: str) -> DataFrame:
    """Squared distances to the nearest row drawn so far, given those before ``new`` was drawn."""

    def measure(batches):
        for pdf in batches:
            x, near = pdf.iloc[:, :-1].to_numpy(dtype=float), pdf["near"].to_numpy(dtype=float, copy=True)
            for c in new:
                near = np.minimum(near, ((x - c) ** 2).sum(1))
            yield pdf.assign(near=near)

    return state.mapInPandas(measure, schema)


def _pass(points: DataFrame, models: dict[int, np.ndarray], dims: int):
    """One reading of the data under several sets of centres: counts, sums and inertia per centre."""
    names = [f"s{d}" for d in range(dims)]

    def partial(batches):
        totals = {m: np.zeros((len(c), dims + 2)) for m, c in models.items()}
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            for m, centres in models.items():
                # the row's own square is the same for all centres
                label = ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
                k, part = len(centres), totals[m]
                part[:, 0] += np.bincount(label, minlength=k)
                part[:, 1] += np.bincount(label, weights=((x - centres[label]) ** 2).sum(1), minlength=k)
                for d in range(dims):
                    part[:, 2 + d] += np.bincount(label, weights=x[:, d], minlength=k)
        out = pd.DataFrame(np.concatenate(list(totals.values())), columns=["n", "inertia", *names])
        out.insert(0, "centre", np.concatenate([np.arange(len(c)) for c in models.values()]))
        out.insert(0, "model", np.repeat(list(models), [len(c) for c in models.values()]))
        yield out[out["n"] > 0]

    schema = "model int, centre int, n double, inertia double, " + ", ".join(f"{c} double" for c in names)
    sums = points.mapInPandas(partial, schema).groupBy("model", "centre").agg(
        *[F.sum(c).alias(c) for c in ["n", "inertia", *names]]
    )
    # one row per centre, whatever the table size
    result = {}
    for r in sums.collect():
        result.setdefault(r["model"], {})[r["centre"]] = (r["n"], r["inertia"], [r[c] for c in names])
    return result


def _fit_all(df: DataFrame, columns, wanted: list[tuple[int, int]], max_iter: int) -> list[tuple[np.ndarray, float]]:
    """Centres and inertia for each wanted (k, seed)."""
    dims = len(columns)
    points = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = points.agg(F.count(F.lit(1)), *[F.var_pop(c) for c in columns]).first()
        n, variance = stats[0], float(np.mean([v or 0.0 for v in stats[1:]]))
        if not n:
            raise ValueError("no complete rows to cluster")
        x, weight = _cells(points, list(columns))
        trial = {m: _spread_starts(x, weight, k, seed) for m, (k, seed) in enumerate(wanted)}
        centres: dict[int, np.ndarray] = {}
        lowest = {m: float("inf") for m in trial}
        active, plain = set(trial), set()
        for _ in range(max_iter):
            if not active:
                break
            got = _pass(points, {m: trial[m] for m in active}, dims)
            for m in list(active):
                inertia = sum(v[1] for v in got[m].values())
                if inertia > lowest[m] and m not in plain:
                    # the settled step led upwards: from the best centres on, the table's own steps, which never do
                    plain.add(m)
                    trial[m] = centres[m]
                    continue
                exact = trial[m].copy()
                for c, (count, _, sums) in got[m].items():
                    exact[c] = np.array(sums) / count
                lowest[m], centres[m] = inertia, exact
                if ((exact - trial[m]) ** 2).sum() <= TOLERANCE * variance:
                    active.discard(m)
                elif m in plain:
                    trial[m] = exact
                else:
                    trial[m] = _settle(x, weight, exact, exact - _step(x, weight, trial[m]))
        final = _pass(points, centres, dims)
        return [(centres[m], sum(v[1] for v in final[m].values())) for m in range(len(wanted))]
    finally:
        points.unpersist()


def kmeans_elbow(df: DataFrame, columns=CORE, ks=ELBOW_RANGE, inits: int = REGIME_INITS,
                 max_iter: int = REGIME_MAX_ITER, seed: int = REGIME_SEED) -> DataFrame:
    """Best inertia per cluster count: ``k, inertia``."""
    wanted = [(k, seed + i) for k in ks for i in range(inits)]
    fits = _fit_all(df, columns, wanted, max_iter)
    best = {}
    for (k, _), (_, inertia) in zip(wanted, fits):
        best[k] = min(inertia, best.get(k, float("inf")))
    return df.sparkSession.createDataFrame([(k, float(v)) for k, v in best.items()], "k int, inertia double")


def fit_regimes(df: DataFrame, columns=CORE, k: int = REGIMES, inits: int = REGIME_INITS,
                max_iter: int = REGIME_MAX_ITER, seed: int = REGIME_SEED) -> Regimes:
    """Best of several starts. Centres are numbered in coordinate order, so labels are stable."""
    fits = _fit_all(df, columns, [(k, seed + i) for i in range(inits)], max_iter)
    centres, inertia = min(fits, key=lambda f: f[1])
    ordered = sorted(tuple(float(v) for v in c) for c in centres)
    return Regimes(tuple(columns), tuple(ordered), float(inertia))


def assign_regimes(df: DataFrame, regimes: Regimes) -> DataFrame:
    """``market_regime`` of the nearest centre and its one-hot columns, as plain expressions."""
    dist = []
    for centre in regimes.centres:
        d = F.lit(0.0)
        for c, v in zip(regimes.columns, centre):
            d = d + F.pow(F.col(c) - F.lit(v), F.lit(2.0))
        dist.append(d)
    with_d = df.withColumn("__d", F.array(*dist))
    label = (F.array_position("__d", F.array_min("__d")) - 1).cast("int")
    out = with_d.withColumn("market_regime", F.when(F.array_min("__d").isNotNull(), label)).drop("__d")
    return out.withColumns({
        name: (F.col("market_regime") == i).cast("int")
        for i, name in enumerate(regime_columns(len(regimes.centres)))
    })


def regime_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("market_regime").agg(F.count(F.lit(1)).alias("rows")).orderBy("market_regime")


def regime_number(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("market_regime").alias("regimes"))


def regime_summary(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows, share, and mean and deviation of the raw target per regime."""
    per = df.groupBy("market_regime").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(target).alias("target_mean"), F.stddev_samp(target).alias("target_std")
    )
    # sums over the few regime rows, not a second reading of the table
    total = F.sum("rows").over(Window.partitionBy())
    return per.withColumn("share_pct", F.col("rows") * 100.0 / total).orderBy("market_regime")


def regime_scatter(df: DataFrame, bins: int = 100,
                   axes=(("wind", "solar"), ("load", "spread"), ("wind", "load"))) -> DataFrame:
    """Points per regime on each pair of axes, counted in a ``bins`` x ``bins`` grid.

    Returns panel, regime, the two cell numbers and the count: at most
    panels * regimes * bins^2 rows however many points there are.
    """
    names = sorted({c for pair in axes for c in pair})
    ends = df.agg(*[f(c).alias(f"{n}_{c}") for c in names for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def cell(c):
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if lo is None or lo == hi:
            return F.lit(0)
        return F.least(F.floor((F.col(c) - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")

    panels = F.array(*[
        F.struct(F.lit(f"{a}_{b}").alias("panel"), cell(a).alias("x_cell"), cell(b).alias("y_cell")) for a, b in axes
    ])
    return df.select("market_regime", F.inline(panels)).groupBy("panel", "market_regime", "x_cell", "y_cell").agg(
        F.count(F.lit(1)).alias("points")
    )
