import numpy as np
from pyspark.sql import functions as F

from slotcast.llm import neighbours


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "a", 1.0) for i, v in rows], "vec_id long, embedding array<float>, id string, score double").repartition(3)


def run(spark, rows, every=1, **settings):
    t = table(spark, rows)
    got = {}
    for r in neighbours.nearest(t, t.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("id")), **settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}


def exact(rows, k=5):
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in kept:
        s = [(-float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), i) for i, y in kept if i != q]
        out[q] = [i for _, i in sorted(s)[:k]]
    return out


def test_recall_through_leaves_descent_and_search(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(1200, 16)))]
    got, truth = run(spark, rows, 20, leaf=100, trees=4), exact(rows)
    assert len(got) == 60
    assert sum(len(set(truth[q]) & {i for i, _ in v}) for q, v in got.items()) >= 0.9 * 5 * len(got)
    assert all(a[1] >= b[1] for v in got.values() for a, b in zip(v, v[1:]))


def test_ties_copies_and_vectors_that_take_no_part(spark):
    rows = [(i, [1, 2, 3, 4]) for i in range(9)] + [(i, [4, 3, 2, float(i)]) for i in range(9, 15)]
    rows += [(20, None), (21, [0, 0, 0, 0]), (22, [1, None, 2, 3]), (23, [1, float("nan"), 2, 3]), (24, [float("inf"), 1, 2, 3]), (25, [1, 2]), (26, [])]
    got = run(spark, rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: v for q, v in exact([r for r in rows if r[0] < 25]).items()}
    assert all(abs(s - 1) < 1e-12 for _, s in got[0])


def test_few_or_no_vectors(spark):
    assert run(spark, [(1, [1, 0])]) == {}
    assert [i for i, _ in run(spark, [(1, [1, 0]), (2, [0, 1])])[1]] == [2]
    t = table(spark, [(1, [1, 0])]).limit(0)
    assert neighbours.nearest(t, t.select(F.col("vec_id").alias("id"))).count() == 0


def test_near_copies_are_told_apart(spark):
    """A third of the vectors lie so close together that half precision can't rank them."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=32)
    rows = [(i, v) for i, v in enumerate(np.concatenate((rng.normal(size=(1600, 32)), centre * (1 + rng.normal(0, 0.0025, (800, 32))))).tolist())]
    got, truth = run(spark, rows, 40, leaf=200), exact(rows)
    near = [q for q in got if q >= 1600]
    assert len(near) == 20
    assert sum(len(set(truth[q]) & {i for i, _ in got[q]}) for q in near) >= 0.9 * 5 * len(near)


def test_components_of_any_size(spark):
    rows = [(i, [x * f for x in v]) for i, (v, f) in enumerate(zip([[1, 2, 3], [1, 2, 4], [3, -1, 0], [1, 2, 3.5]], [1e200, 1e-200, 1.0, 1e300]))]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in neighbours.nearest(t, t.select(F.col("vec_id").alias("id"))).collect()}
    unit = [np.array(v) / np.linalg.norm(v) for v in ([1, 2, 3], [1, 2, 4], [3, -1, 0], [1, 2, 3.5])]
    assert len(got) == 12 and all(abs(s - unit[a] @ unit[b]) < 1e-12 for (a, b), s in got.items())
