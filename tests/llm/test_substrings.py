import random

import pytest
from helpers import documents, prose

from slotcast.llm import substrings


def brute(texts: dict, window: int) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        words = (texts[i] or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("window, anchor, vocabulary", [(20, 8, 400), (5, 3, 6), (4, 4, 5), (6, 1, 3)])
def test_equals_brute_force(spark, window, anchor, vocabulary):
    rng = random.Random(window)
    passage = prose(rng, 70, vocabulary)
    texts: list = [None, "", " \n\t ", "one", "zażółć gęślą"]
    for _ in range(60):
        words = prose(rng, rng.randrange(5, 120), vocabulary)
        if rng.random() < 0.5:
            a = rng.randrange(0, 40)
            words[3:3] = passage[a : a + rng.randrange(2, 45)]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    texts += [texts[-1], texts[-1].upper(), texts[10]]
    texts.append(" ".join(["same"] * 100))
    texts.append(" ".join(prose(rng, 3000, vocabulary)))
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.deduplicated(docs, window, anchor).collect()}
    assert got == brute(dict(enumerate(texts)), window)


def test_empty_table(spark):
    assert substrings.deduplicated(documents(spark, ["a"]).limit(0)).count() == 0


def test_short_texts_only(spark):
    assert {r["n_removed"] for r in substrings.deduplicated(documents(spark, ["a b c", "a b c", None])).collect()} == {0}


def test_rows_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (3, text), (5, text)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in substrings.deduplicated(docs).collect()) == [(0, 0), (3, 0), (5, 30)]


def test_repeated_rows_lose_nothing_by_each_other(spark):
    """The same id twice: with the same text nothing is earlier, with another text the rows stay apart."""
    rng = random.Random(5)
    one, two, other = (" ".join(prose(rng, 60, 5000)) for _ in range(3))
    rows = [(1, one)] * 2 + [(2, two), (2, other)] + [(3, one), (3, one), (4, f"{two} {other}"), (5, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.deduplicated(docs).collect())
    assert got == sorted([
        (1, 60, 0, one), (1, 60, 0, one), (2, 60, 0, two), (2, 60, 0, other), (3, 60, 60, ""), (3, 60, 60, ""), (4, 120, 120, ""), (5, 0, 0, ""), (5, 0, 0, ""),
    ])


def test_a_line_in_every_document(spark):
    rng = random.Random(6)
    line = prose(rng, 30, 5000)
    texts = [" ".join(prose(rng, 10, 5000) + line + prose(rng, 10, 5000)) for _ in range(300)]
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.deduplicated(docs).collect()}
    assert got == brute(dict(enumerate(texts)), 20)
