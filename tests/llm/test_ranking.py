"""Ranked search against a brute-force version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LOWER, documents, prose

from slotcast.llm import ranking

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "item_id long, text string, score int, rank string"


def counts(text):
    return Counter(TERMS.findall((text or "").translate(LOWER)))


def expected(docs, items, k=10):
    tf = [(i, counts(t)) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    documents_, total = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(counts(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for i, c in tf:
            m = 100 - 90 + (90 * c.total() * documents_) // total
            score = sum(math.floor(1000 * math.log((2 * documents_ + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string").repartition(3)
    q = spark.createDataFrame([(i, t, 1, "x") for i, t in items], SCHEMA)
    return sorted((tuple(r) for r in ranking.ranked(d, q, **options).collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    docs = [(i, " ".join(prose(rng, rng.randrange(1, 60), 150))) for i in range(300)]
    passage = " ".join(prose(rng, 20, 400))
    docs += [(300 + i, f"{passage}, {docs[i][1]}") for i in range(30)]  # ties and near ties
    docs += [(400 + i, "W1 w1\tÉté été W2-w3 _w4_") for i in range(15)] + [(400, "w1 w9")]
    docs += [(500, None), (501, ""), (502, "-- !!"), (503, "w1 " * 3000), (504, "w" * 200_000), (None, passage)]
    items = [(i, " ".join(prose(rng, rng.randrange(1, 25), 400))) for i in range(25)] + [(40, passage), (40, "w1"), (41, None), (42, "nowhere"), (43, "Été W2"), (None, "w3")]
    return docs, items


def test_equals_brute_force(spark, corpus):
    assert found(spark, *corpus) == expected(*corpus)


def test_items_in_blocks(spark, corpus):
    docs, items = corpus
    assert found(spark, docs, items, item_entries=60, k=3) == expected(docs, items, 3)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = " ".join(prose(rng, 500)) + " " + "ä" * 300 + "," * 200 + " End"
    monkeypatch.setattr(ranking, "PIECE", 64)
    assert ranking.term_counts(text.encode()) == Counter(t.encode() for t in counts(text).elements())


def blocks(rng, documents_, width, entries):
    sizes = rng.integers(1, entries, documents_)
    terms = np.concatenate([np.sort(rng.choice(width, s, replace=False)) for s in sizes])
    values = rng.integers(1, 10**9, len(terms)) * rng.integers(0, 20, len(terms))
    return ranking.Rows(np.concatenate(([0], np.cumsum(sizes))), terms, values)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_are_never_too_low(seed):
    rng = np.random.default_rng(seed)
    rows, items = blocks(rng, 400, 80, 30), blocks(rng, 20, 80, 12)
    items = ranking.Rows(items.edges, items.terms, np.ones(len(items.terms)))
    tree = ranking.BallTree(rows, items, 80)
    assert sorted(p for places in tree.leaves.values() for p in places.tolist()) == list(range(400))
    for leaf, places in tree.leaves.items():
        for item in range(20):
            dense = np.zeros(80, np.int64)
            dense[items.terms[items.edges[item] : items.edges[item + 1]]] = 1
            assert int(rows.take(places).dot(dense).max()) <= tree.bounds[leaf][item]


def test_subtrees_are_pruned():
    """Items that stand in few documents need few leaves; the result is that of all leaves."""
    rng = np.random.default_rng(8)
    rows = blocks(rng, 2048, 3000, 60)
    rows = ranking.Rows(rows.edges, rows.terms, np.maximum(rows.values, 1))
    items = ranking.Rows(np.arange(0, 55, 5), rng.choice(3000, 50, replace=False), np.ones(50))
    search = ranking.Search(items, 3000, 10)
    search.add(np.arange(2048), rows)
    assert search.leaves_scored < 0.4 * search.leaves_seen
    for item in range(10):
        dense = np.zeros(3000, np.int64)
        dense[items.terms[5 * item : 5 * item + 5]] = 1
        scores = rows.dot(dense)
        best = [i for i in np.lexsort((np.arange(2048), -scores)) if scores[i] > 0][:10]
        assert search.ids[item].tolist() == best and search.scores[item].tolist() == scores[best].tolist()
