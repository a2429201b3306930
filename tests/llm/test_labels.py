import random

import pytest

from slotcast.llm.common import contracted_labels


def least_reachable(edges):
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in parent}


def random_edges(seed, nodes=60, count=45):
    rng = random.Random(seed)
    return [tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(count)]


# In the first graph node 2 stands only on the left and is nobody's least neighbour.
@pytest.mark.parametrize("edges", [[(1, 3), (2, 3)], [(1, 4), (2, 4), (2, 5), (3, 5)], random_edges(1), random_edges(2), random_edges(3, 40, 60)])
def test_contracted_labels_equal_union_find(spark, edges):
    got = contracted_labels(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["label"] for r in got} == least_reachable(edges)
