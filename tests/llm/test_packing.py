"""Packing against the tokenizer library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import prose
from slotcast.llm import packing
from slotcast.llm.queries import QUERIES, tokenizer

FILE = tokenizer("byte_bpe_50k.json")
rng = random.Random(4)
TEXTS = [
    None, "", " ", "a", "hello world", "Größe  ist\n\n\t42 %!", "it's <|endoftext|> here", " x\u0085y z", "漢字かな交じり文 😀😀", "x" * 5000, " " * 5000,
    "\n" * 3000 + "end", *(" ".join(prose(rng, n, 4000)) for n in (3, 50, 700, 900, 5000)), " a" * 1023, " a" * 2047, " a" * 2048,
]


def library_ids(text):
    library = Tokenizer.from_file(FILE)
    library.encode_special_tokens = True
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], "doc_id long, text string, ids string, part int, length int").repartition(3)


@pytest.fixture(scope="module")
def found(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id")]
    df = packing.packed(table(spark, rows), FILE, pattern=public_tokenizers.PATTERN)
    return rows, [r.asDict() for r in df.withColumn("crc", F.crc32("ids")).collect()]


def test_pieces_hold_each_id_once(found):
    rows, got = found
    for i, text in rows:
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        want = library_ids(text)
        if i == 3:  # a repeated row is packed for itself
            assert len(own) == 2 * len(packing.cuts(len(want)))
            own = own[::2]
        assert b"".join(bytes(r["ids"]) for r in own) == np.array(want, "<u4").tobytes()
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own[:-1])]).tolist()
        assert {r["doc_tokens"] for r in own} == {len(want)}
        assert all(r["crc"] == zlib.crc32(bytes(r["ids"])) and len(r["ids"]) == 4 * r["length"] for r in own)


def test_sequences_are_bucketed_without_padding(found):
    _, got = found
    assert all(r["length"] in {1 << b for b in range(11)} and r["offset"] == 0 for r in got)
    got.sort(key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in got] == list(range(len(got)))
    lengths = [r["length"] for r in got]
    assert lengths == sorted(lengths, reverse=True)  # equal lengths are one range of ids


@pytest.mark.parametrize("count", [1, 2, 3, 1023, 1024, 1025, 4095, 10_000])
def test_cuts(count):
    got = packing.cuts(count).tolist()
    assert sum(got) == count and got == sorted(got, reverse=True) and len(set(got) - {1024}) == len([x for x in got if x != 1024])
    assert packing.cuts(5, 1).tolist() == [1] * 5 and packing.cuts(7, 2).tolist() == [2, 2, 2, 1]


def test_both_encoders_agree():
    with open(FILE, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read(), public_tokenizers.PATTERN)
    assert encoder.fast is not None
    dice = random.Random(6)
    marks = "aZé ß0٣ \n\t\r.,'s  ​ 漢😀́\u0000"
    for _ in range(300):
        text = "".join(chr(dice.choice([dice.randrange(0xD800), dice.randrange(0xE000, 0x110000)])) if dice.random() < 0.2 else dice.choice(marks) for _ in range(dice.randrange(200)))
        assert encoder.ids(text).tolist() == library_ids(text)[:-1]


def test_other_files_go_through_their_library(spark):
    file = tokenizer("word_bpe_49k.json")
    got = packing.packed(table(spark, [(1, "Hello big World")]), file, longest=4, end=7, pattern=public_tokenizers.PATTERN).collect()
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in sorted(got, key=lambda r: r["start"])]).tolist()
    assert ids == [*Tokenizer.from_file(file).encode("Hello big World", add_special_tokens=False).ids, 7]


def test_empty_table_and_wrong_length(spark):
    assert packing.packed(table(spark, [(1, "a")]).limit(0), FILE).count() == 0
    with pytest.raises(ValueError):
        packing.packed(table(spark, [(1, "a")]), FILE, longest=1000)


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_packing"](spark, folder).toPandas()
    want = {(i, s): (n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()), len(ids)) for i, t in docs.items() for ids in [library_ids(t)] for s, n in starts(len(ids))}
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in got.itertuples()} == want
    assert got["sequence_id"].is_unique


def starts(count):
    lengths = packing.cuts(count).tolist()
    return zip(np.cumsum([0, *lengths[:-1]]).tolist(), lengths)
