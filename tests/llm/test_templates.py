import random

from helpers import documents
from pyspark.sql import functions as F

from slotcast.llm import templates

ITEM = "Once upon a time the farmer Alice Smith sold 12 apples to Bob for 3 dollars and then Alice Smith bought 12 pears from Bob."
PLAIN = "that every thing was right and nobody would ever know what had been done to the old house by the river"


def judged(spark, texts, items):
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    return {r["doc_id"]: r for r in templates.contaminated(documents(spark, texts), table).collect()}


def test_slots_are_checked(spark):
    texts = [
        "So the farmer Carol sold 15 apples to Dan for 9 dollars and then Carol bought 15 pears from Dan. Yes",  # other names and numbers, consistently
        "So the farmer Carol sold 15 apples to Dan for 9 euros and then Erin bought 17 pears from Dan. Yes",  # one name stands for two
        "So the farmer Carol sold 15 apples to Carol for 9 dollars and then Carol bought 15 pears from Carol. Yes",  # two names for one
        f"Intro. {ITEM} Outro.", "The farmer sold apples.", None, "", PLAIN.upper(), f"xx {PLAIN} yy", PLAIN[: len(PLAIN) // 3],
        "filler " * 30_000 + PLAIN, f"xx {PLAIN} yy",
    ]
    got = judged(spark, texts, [ITEM, PLAIN, None, "", "too short", PLAIN])
    assert [i for i in range(len(texts)) if got[i]["contaminated"]] == [0, 3, 7, 8, 10, 11]
    assert got[3]["items"] == [0] and got[8]["items"] == [1, 5] and got[8]["n_items"] == 2 and got[5]["items"] == []


def test_blocks_of_benchmark_windows(spark, monkeypatch):
    monkeypatch.setattr(templates, "BLOCK", 5)
    assert judged(spark, [f"x {ITEM}", f"y {PLAIN}", "z"], [ITEM, PLAIN])[1]["items"] == [1]


def test_empty_tables(spark):
    assert {r["contaminated"] for r in judged(spark, [PLAIN], [None]).values()} == {False}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in templates.contaminated(documents(spark, [PLAIN]), empty).collect()} == {False}
    assert templates.contaminated(documents(spark, ["a"]).limit(0), empty).count() == 0


def test_long_runs_of_names_and_numbers(spark):
    """Neither a run of names nor the parts of a number are followed by recursion, on either side."""
    names, parts = "von " + "Von Zürich " * 50_000, "12" + "".join(f"{'.,:/'[i % 4]}{i}" for i in range(100_000))
    texts = [f"a {names}b", f"a {parts} b", f"{ITEM} So the {names}and the {parts}", f"So the {names}and the {parts} of {PLAIN}", "Von " * 50_000]
    got = judged(spark, texts, [ITEM, PLAIN, f"then the {names}and the {parts} went home again with many others that evening"])
    assert [got[i]["items"] for i in range(len(texts))] == [[], [], [0], [1], []]


def test_patterns_find_what_those_of_the_sql_find(spark):
    rng = random.Random(4)
    pieces = ["a", "é", "\U00010428", "a ", "; ", "B", "É", "\U00010400", " B", " É", " ", ",", ".", ":", "/", "7", "80", "\n"]
    texts = ["".join(rng.choices(pieces, k=60)) for _ in range(2000)]
    table = documents(spark, texts)
    for plain, loop, group in ((templates.NAMES_RE, templates.NAMES_LOOP, 2), (templates.NUMBERS_RE, templates.NUMBERS_LOOP, 1)):
        assert plain != loop
        found = table.select(*(F.regexp_extract_all("text", F.lit(p), group).alias(n) for n, p in (("plain", plain), ("loop", loop))))
        assert found.where("size(plain) > 1").count() > 1000 and found.where("plain <> loop").count() == 0


def test_finds_what_contains_an_item(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    bench = [r["text"] for r in items.collect()]
    expected = {r["doc_id"] for r in docs.collect() if r["text"] and any(b in r["text"] for b in bench)}
    assert {r["doc_id"] for r in templates.contaminated(docs, items).where("contaminated").collect()} == expected
