"""Language identification and toxicity: held-out accuracy and defined results."""

import zlib

import pytest
from helpers import documents
from pyspark.sql import functions as F

from slotcast.llm import language, toxicity
from slotcast.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def truth(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id", "left")
    return {r["doc_id"]: r for r in docs.select("doc_id", "lang", "toxic").collect()}


def test_held_out_languages(spark, truth):
    got = {r["doc_id"]: r for r in QUERIES["op6_language"](spark, FOLDER).collect()}
    assert set(got) == set(truth)
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i]["held_out"]} == set(held)
    assert sum(got[i]["lang_pred"] == truth[i]["lang"] for i in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_toxicity(spark, truth):
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, FOLDER).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1 and truth[i]["toxic"] is not None]
    assert all(got[i]["held_out"] for i in held) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    toxic, clean = ([got[i]["score"] for i in held if truth[i]["toxic"] == k] for k in (1, 0))
    assert sum(a > b for a in toxic for b in clean) >= 0.95 * len(toxic) * len(clean)
    assert sum(s >= 0.7 for s in toxic) >= 0.75 * len(toxic)
    assert sum(s >= 0.7 for s in clean) <= 0.02 * len(clean)


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    odd = documents(spark, [None, "", "123 !?", "the dog and the cat", "the dog and the cat", "und die katze " * 20_000, "日本語"])
    got = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in range(6)] == ["und", "und", "und", "en", "en", "de"]
    assert [got[i]["score"] for i in range(3)] == [0, 0, 0] and got[2]["rejected"] and not got[3]["rejected"]
    assert got[6]["lang_pred"] in ("de", "en")


@pytest.mark.parametrize("learned", [("en",), ("de", "en"), ("de", "en", "es")])
def test_unlearned_languages_and_gibberish_are_rejected(spark, learned):
    import random

    rng = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and length(text) > 200").select("doc_id", "text", "lang")
    model = language.fit(docs.where(F.col("lang").isin(*learned) & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2)))
    held = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    rejected = lambda rows: [r["rejected"] for r in language.predict(rows, model).collect()]
    own, foreign = rejected(held.where(F.col("lang").isin(*learned))), rejected(docs.where("lang = 'fr'"))
    noise = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(20)) for _ in range(50)]
    assert sum(own) <= 0.02 * len(own)
    assert sum(foreign) >= 0.9 * len(foreign) and sum(rejected(documents(spark, noise))) == 50
    print("rejected", learned, sum(own), len(own), sum(foreign), len(foreign))


def test_without_training_rows(spark):
    docs = documents(spark, ["some text", None])
    model = language.fit(docs.where("lang is null"))
    assert {r["lang_pred"] for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(0, 1), (1, None)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] < 0.01 for r in toxicity.scores(docs, machine).collect()} == {True}
    assert toxicity.scores(docs, toxicity.fit(docs, labels)).count() == 2


def test_toxicity_learns_pairs():
    import random

    import numpy as np

    rng = random.Random(2)
    rows, labels = [], []
    for _ in range(1500):  # only both words together are toxic
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = ["insult"] * a + ["group"] * b + [f"w{rng.randrange(30)}" for _ in range(8)]
        rows.append(np.array(sorted({t for w in words for t in toxicity.word_terms(w)})))
        labels.append(int(a and b))
    machine = toxicity.train(rows, np.array(labels), sum(labels) / len(labels))
    assert machine.score("insult group w1 w2") > 0.7 > max(machine.score("insult w1 w2"), machine.score("group w1 w2"))


def test_toxicity_learns_pairs_of_words_that_tell_nothing_alone():
    import random

    import numpy as np

    rng = random.Random(3)

    def text():
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = ["insult"] * a + ["group"] * b + [f"w{rng.randrange(30)}" for _ in range(8)]
        rng.shuffle(words)
        return " ".join(words), int(a == b)

    made = [text() for _ in range(6000)]
    rows = [np.array(sorted({t for w in set(x.split()) for t in toxicity.word_terms(w)})) for x, _ in made]
    machine = toxicity.train(rows, np.array([y for _, y in made]), 0.5)
    held = [text() for _ in range(1000)]
    assert sum((machine.score(x) >= 0.5) == bool(y) for x, y in held) >= 950


def test_toxicity_of_long_and_repeated_rows(spark):
    rows = [(i, f"{'awful' if i % 2 else 'nice'} word{i} text") for i in range(400)] * 2
    docs = spark.createDataFrame(rows + [(900, "awful " * 100_000), (901, "nice " * 100_000), (901, "nice " * 100_000), (902, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] * 2, "doc_id long, toxic int")
    got = toxicity.scores(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 804
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[900] > 0.9 and score[901] < 0.1 and score[1] > 0.9 > 0.1 > score[0]
