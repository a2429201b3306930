import random

import numpy as np
import pytest
import sentencepiece

from slotcast.llm import pieces
from slotcast.llm.queries import tokenizer

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.Pieces(pieces.model_bytes(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encodes_and_decodes_as_the_library(both):
    own, library = both
    rng = random.Random(3)
    kinds = ["ab c▁\n\t", "  ▁", "aeiou hTN.,", "日本語 é😀\x00<0x0A>s/ ", "The quick brown fox jumps, over 13 lazy dogs. "]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(60)))
        expected = library.encode(text, add_bos=True, add_eos=True)
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert own.decode(ids) == library.decode(expected)


def test_decodes_any_ids_as_the_library(both):
    own, library = both
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(259) for _ in range(rng.randrange(9))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_long_runs_and_spaces(both):
    own, library = both
    for text in ("x" * 20_000, " " * 5_000, "ab " * 20_000, "\n" * 3_000):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_rows_nulls_repeats_and_clashing_columns(spark, both):
    from helpers import documents

    texts = [None, "", "hello  world", "hello  world", " \n", "é" * 500]
    got = {r["doc_id"]: r for r in pieces.encode(documents(spark, texts), MODEL).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == both[1].encode(text or "", add_bos=True, add_eos=True)
        assert got[i]["decoded"] == (text or "")
    assert pieces.encode(documents(spark, ["a"]).limit(0), MODEL).count() == 0
