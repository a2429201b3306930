import numpy as np
import pytest

from slotcast import fit_regimes, kmeans_elbow
from slotcast.operators.regimes import _cells, _settle, _step

AXES = ("a", "b")


def frame(spark, x, parts=4):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double").repartition(parts)


def lloyd(x, centres):
    """Plain steps over all rows until nothing moves: centres and inertia."""
    for _ in range(1000):
        new = _step(x, np.ones(len(x)), centres)
        if np.array_equal(new, centres):
            break
        centres = new
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


def test_cells_cover_every_row_and_hot_rows_too(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (1500, 2)), np.tile([[4.0, 4.0]], (900, 1)), rng.normal(40, 0.1, (3, 2))])
    for parts in (1, 5):
        means, rows = _cells(frame(spark, x, parts), AXES)
        assert rows.sum() == len(x) and len(means) < len(x) and (rows > 0).all()
        assert np.allclose((means * rows[:, None]).sum(0) / rows.sum(), x.mean(0))
        near = ((means - [4, 4]) ** 2).sum(1).argmin()
        assert rows[near] >= 900
        assert (means > 30).all(1).sum() >= 1  # three rows far away have a cell of their own


def test_shifted_steps_rest_where_the_tables_steps_rest():
    """Cells much coarser than the table: without the shift they rest elsewhere."""
    x = np.random.default_rng(4).normal(0, 1, (4000, 2))
    corner = np.floor(x)
    cells, label, rows = np.unique(corner, axis=0, return_inverse=True, return_counts=True)
    cells = np.stack([np.bincount(label.ravel(), weights=x[:, d]) for d in range(2)], 1) / rows[:, None]
    centres = x[:3]
    for _ in range(40):
        exact = _step(x, np.ones(len(x)), centres)
        centres = _settle(cells, rows, exact, exact - _step(cells, rows, centres))
        if np.allclose(centres, _step(x, np.ones(len(x)), centres), atol=1e-3):
            break
    plain = lloyd(x, x[:3])[1]
    assert ((x[:, None] - centres) ** 2).sum(2).min(1).sum() <= plain * 1.02


@pytest.mark.parametrize("k", [1, 3, 6])
def test_no_worse_than_plain_steps_from_ten_starts(spark, k):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in ((0, 1, 2500), (3, 0.5, 900), (-4, 2, 300))])
    found = fit_regimes(frame(spark, x), AXES, k)
    plain = min(lloyd(x, x[rng.choice(len(x), k, replace=False)])[1] for _ in range(10))
    assert found.inertia <= plain * 1.002
    centres = np.array(found.centres)
    moved = _step(x, np.ones(len(x)), centres) - centres
    assert (moved ** 2).sum() <= 1e-3 * x.var(0).mean()  # at rest over all rows, not only over cells
    assert found.inertia == pytest.approx(((x[:, None] - centres) ** 2).sum(2).min(1).sum(), rel=1e-9)


def test_fewer_distinct_rows_than_clusters(spark):
    x = np.array([[1.0, 1.0]] * 5 + [[2.0, 2.0]] * 4)
    got = {r["k"]: r["inertia"] for r in kmeans_elbow(frame(spark, x), AXES, ks=(1, 2, 4), inits=2).collect()}
    assert got[1] == pytest.approx(2 * 9 * 0.25 * (80 / 81)) and got[2] == pytest.approx(0) and got[4] == pytest.approx(0)
    with pytest.raises(ValueError):
        fit_regimes(frame(spark, x).limit(0), AXES)
