"""The pipeline's stages against brute-force versions on the smallest tables."""

import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import near_components

import corpus_pipeline
from slotcast.llm import minhash, secrets
from slotcast.llm.common import per_worker, prepared
from slotcast.llm.queries import tokenizer

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_on_its_own_input(spark):
    prepared(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    bench = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r for r in docs.collect()}
    out = {name: stage(spark, docs, FOLDER) for name, stage in corpus_pipeline.STAGES}
    kept = {name: {r["doc_id"]: r for r in df.collect()} for name, df in out.items()}
    assert [df.columns for df in list(out.values())[:-1]] == [COLUMNS] * 4
    assert len(kept["language"]) >= 0.99 * len(rows)
    components = near_components({i: r["text"] for i, r in rows.items()}, 5, 80)
    assert set(kept["near_copies"]) == {i for i, c in components.items() if i == c}
    assert set(kept["unleaked"]) == {i for i, r in rows.items() if not any(b in (r["text"] or "") for b in bench)}
    encode = secrets._encoder(open(tokenizer("byte_bpe_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    for i, r in rows.items():
        spans = secrets.scan(r["text"] or "", encode)
        assert kept["without_secrets"][i]["text"] == (secrets.blotted(r["text"], spans) if spans else r["text"])
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    for i, r in rows.items():
        assert np.frombuffer(kept["tokens"][i]["ids"], "<u4").tolist() == library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert kept["tokens"][i]["decoded"] == (r["text"] or "")


def test_odd_rows_go_through(spark):
    prepared(spark)
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (3, "!!!", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, FOLDER).count() >= 1
    assert corpus_pipeline.STAGES[0][1](spark, docs, FOLDER).count() == 0


class Taken:
    """Takes the function that an operator gives to Spark."""

    def select(self, *columns):
        return self

    def mapInArrow(self, make, schema):
        self.make = make
        return self


class Encoder:
    """Stands for the tables of an operator."""


def test_workers_let_go_of_what_other_operators_keep():
    """Executors reuse their workers: tokenizers of an earlier stage don't stay in those that sketch texts."""
    held = weakref.ref(per_worker("an encoder", Encoder))
    assert per_worker("an encoder", Encoder) is held()
    rows = Taken()
    minhash.features(rows, 5, True)
    batch = pa.record_batch({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array(["a b c d e f", None])})
    assert [r for out in rows.make(iter([batch])) for r in out.column(1).to_pylist()] == [2, 0]
    assert held() is None


def test_a_worker_keeps_one_operators_tables():
    first = weakref.ref(per_worker("first", Encoder))
    second = per_worker("second", Encoder)
    assert first() is None and per_worker("second", Encoder) is second


def test_sets_do_not_depend_on_how_texts_are_sliced(monkeypatch):
    texts = [" ".join(f"w{(i * k) % 23}" for i in range(60)) for k in range(1, 9)] + ["", None, "one two"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    found = []
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(minhash, "TEXT_BYTES", size)
        rows = Taken()
        minhash.features(rows, 5, True)
        found.append([r for out in rows.make(iter([batch])) for r in out.to_pylist()])
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts)
