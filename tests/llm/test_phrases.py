"""Phrase mining against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import LOWER, prose

from slotcast.llm import phrases


def expected(rows, least, longest=4, top=None):
    f, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(own)
            for n in range(1, longest + 1):
                f[lang].update(" ".join(own[i : i + n]) for i in range(len(own) - n + 1))
    out = []
    for lang, counts in f.items():
        big = {p: a for p, a in counts.items() if " " in p and a >= least}
        holders = Counter()
        for p, a in big.items():
            w = p.split(" ")
            for n in range(2, len(w)):
                for i in range(len(w) - n + 1):
                    q = " ".join(w[i : i + n])
                    holders[q] = max(holders[q], a)
        scored = []
        for p, a in big.items():
            w = p.split(" ")
            cuts = [(2000000 * a // (l + r), k, l, r) for k in range(1, len(w)) for l, r in [(counts[" ".join(w[:k])], counts[" ".join(w[k:])])]]
            score, _, l, r = min(cuts)
            if 100 * holders[p] < 80 * a:
                scored.append((-score, -a, p.encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, words[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, l, t, 1, "x") for i, (l, t) in enumerate(rows)], "doc_id long, lang string, text string, n int, phrase string").repartition(4)


def corpus(seed, n=120):
    rng = random.Random(seed)
    fixed = ["new York City hall", "Black forest", "state of the art", "état de droit", "a a a a a a"]
    rows = []
    for _ in range(n):
        words = prose(rng, rng.randrange(5, 60), 60)
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words)), rng.choice(fixed))
        for _ in range(rng.randrange(6)):
            words.insert(rng.randrange(len(words)), rng.choice([".", "x,", "\n", "\t", "  ", "!?", " ", "\x0b"]))
        rows.append((rng.choice(["en", "en", "de", None]), " ".join(words)))
    rows += [("en", None), ("en", ""), (None, " .,"), ("fr", "only words here"), rows[0], rows[0]]
    rows.append(("en", "tie one. " * 40 + "tie two; " * 40 + "y" * 100_000 + " w1 " * 3000))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_equals_brute_force(spark, shards):
    rows = corpus(shards)
    got = phrases.collocations(table(spark, rows), least=9, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 9)


def test_top_and_small_slices(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(phrases, "HELD", 50)
    assert sorted(tuple(r) for r in phrases.collocations(table(spark, rows), least=6, top=7).collect()) == expected(rows, 6, top=7)


def test_full_slots_change_nothing(spark, monkeypatch):
    """With two slots every phrase looks frequent early; counts must stay whole."""
    from pyspark import cloudpickle

    monkeypatch.setattr(phrases, "SLOTS", 2)
    cloudpickle.register_pickle_by_value(phrases)  # workers take the module as it is here
    try:
        rows = corpus(7, 60)
        assert sorted(tuple(r) for r in phrases.collocations(table(spark, rows), least=8, shards=3).collect()) == expected(rows, 8)
    finally:
        cloudpickle.unregister_pickle_by_value(phrases)


def test_lengths_interleave(spark):
    """Pairs are counted while words still are, and every pair gets one full cycle."""
    keys = [spark.createDataFrame([("en", "p q. " * 40)] * 2, "lang string, text string") for _ in range(3)]
    state = phrases.frequent(keys, 30, 2)
    words, pairs = state[1].collect(), state[2].collect()
    assert [r["hot"] for r in words] == [0, 0]
    (pair,) = pairs
    assert pair["hot"] == 1 and [pair[c] for c in ("c0", "c1", "c2")] == [80, 80, 80]


def test_empty_tables(spark):
    assert phrases.collocations(table(spark, [("en", "a b")]).limit(0)).count() == 0
    assert phrases.collocations(table(spark, [(None, None), ("en", "a b")])).count() == 0


def test_due_is_a_full_cycle():
    hot = np.zeros(phrases.SLOTS, np.uint64)
    a, b = np.array([1 << 30], np.uint64), np.array([(1 << 63) + (1 << 35)], np.uint64)
    for keys, step in ((a, 1), (b, 3)):
        for place in phrases.slots(keys):
            hot[place] |= np.uint64(1 << step)
    assert [s for s in range(12) if phrases._due(hot, a, b, s, 4)[0][0]] == [4, 5, 6, 7]
    assert phrases._due(hot, a, b, 6, 4)[1][0] == 4
