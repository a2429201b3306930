import random

import numpy as np
import pytest
from helpers import documents, edited, near_components, prose, shingles
from pyspark.sql import functions as F

from slotcast.llm import minhash


def texts_with_copies():
    rng = random.Random(7)
    base = prose(rng, 120, 5000)
    texts: list = [None, "", "  \n", "one", "One", "one two three", "ONE two three"]
    texts += [" ".join(prose(rng, rng.randrange(6, 150), 5000)) for _ in range(40)]
    texts += [" ".join(base)] * 3
    texts += [" ".join(edited(rng, base, rng.randrange(0, 9))) for _ in range(60)]
    texts.append(" ".join(prose(rng, 20_000, 5000)))
    texts.append(texts[-1] + " end")
    return texts


@pytest.mark.parametrize("n, block", [(4, 1024), (5, 8)])
def test_components_equal_all_pairs(spark, n, block):
    texts = texts_with_copies()
    got = {r["doc_id"]: r for r in minhash.near_duplicates(documents(spark, texts), n=n, percent=80, block=block).collect()}
    expected = near_components(dict(enumerate(texts)), n, 80)
    assert {i: r["component_id"] for i, r in got.items()} == expected
    for i, text in enumerate(texts):
        assert got[i]["n_shingles"] == len(shingles(text, n)) and got[i]["kept"] == (expected[i] == i)


def test_without_links_and_without_rows(spark):
    assert {r["kept"] for r in minhash.near_duplicates(documents(spark, ["a b c d e f", "g h i j k l", None])).collect()} == {True}
    assert minhash.near_duplicates(documents(spark, ["a"]).limit(0)).count() == 0


def test_registers_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    for common, own in ((800, 100), (300, 200), (20, 2)):
        a = rng.integers(0, 2**63, common + own, dtype=np.uint64)
        b = np.concatenate((a[:common], rng.integers(0, 2**63, own, dtype=np.uint64)))
        rows = minhash.sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        similarity = common / (common + 2 * own)
        assert abs((rows[0] == rows[1]).mean() - similarity) < 5 * np.sqrt(similarity * (1 - similarity) / rows.shape[1])
        union = minhash.sketches(np.unique(np.concatenate((a, b))), np.array([0, common + 2 * own]))
        assert (union[0] == np.maximum(rows[0], rows[1])).all()


def test_estimate_keeps_pairs_at_the_threshold():
    equal = np.array([int(0.8 * minhash.REGISTERS), int(0.5 * minhash.REGISTERS)])
    greater = (minhash.REGISTERS - equal) // 2
    assert minhash.may_reach(equal, greater, 100.0, np.array([100.0, 100.0]), 0.8).tolist() == [True, False]


def test_rows_without_an_id(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(None, text), (3, text), (5, text), (None, "z")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert (3, 3, True) in got and (5, 3, False) in got and all(not k for i, _, k in got if i is None)


def test_many_classes_outside_the_largest_component(spark, monkeypatch):
    """Templated texts that share bands but don't link: one group, nearly all of it outside the largest component."""
    rng = random.Random(3)
    base = prose(rng, 150, 5000)
    texts = [" ".join(edited(rng, base, 8)) for _ in range(160)]
    texts += [" ".join(edited(rng, texts[5 * i].split(), 2)) for i in range(12)]
    rng.shuffle(texts)
    held = []

    def spy(members, percent, settle=minhash._blocks):
        held.append(members.groupBy("cluster", "block").count().agg({"count": "max"}).first()[0])
        return settle(members, percent)

    monkeypatch.setattr(minhash, "_blocks", spy)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, texts), n=4, percent=80, block=32).collect()}
    assert got == near_components(dict(enumerate(texts)), 4, 80)
    assert len(set(got.values())) > 120 and len(held) > 2 and max(held) <= 64


def test_every_pair_with_a_class_outside_meets_once(spark):
    rows = [(i, 7, 1 if i < 50 else i, 1, i % 3) for i in range(90)]
    dealt = minhash.tiles(spark.createDataFrame(rows, "doc_id long, cluster long, label long, main long, side int").withColumns({"sketch": F.lit(b""), "elements": F.lit(b"")}), 16).collect()
    seen = {}
    for block in {r["block"] for r in dealt}:
        sides = [{r["doc_id"] for r in dealt if r["block"] == block and r["side"] == k} for k in (0, 1)]
        met = {(min(a, b), max(a, b)) for a in sides[0] for b in sides[1] or sides[0] if a != b}
        for pair in met:
            seen[pair] = seen.get(pair, 0) + 1
    assert set(seen) == {(a, b) for b in range(50, 90) for a in range(b)} and set(seen.values()) == {1}
