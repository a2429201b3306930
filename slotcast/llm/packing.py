"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document's ids (of a tokenizer file, then an end id) are cut into pieces of ``longest`` ids and, for what is left, one
piece for each binary digit of its length, longest first. Every piece is a sequence of its own, and sequences of equal
length are one bucket, from which batches of equal shape are drawn. Sequence ids run through the buckets, longest first:
those of a bucket are one unbroken range. Pieces are numbered inside each task as they are cut, written once, and moved
by the number of pieces of their bucket in the tasks before, so numbering needs neither a sort nor a single task for all.

Byte-level vocabularies whose ids follow their merges are encoded through a faster library with the same ids; other files,
and texts holding a run without a break of more than ``RUN`` characters, go through the file's own library.

Null and empty texts are the end id alone. Rows with equal ids, or without an id, are packed each for itself. An empty
table gives no rows. Columns besides id and text are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import lookup, per_worker, stored

LONGEST, END = 1024, 0
RUN = 2000
ROWS = 64  # documents encoded before their pieces are handed on
# Bytes that stand for themselves in byte-level vocabulary files; the others follow from 256 on, in order.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _ranks(file: dict, pattern: str | None) -> dict[bytes, int] | None:
    """Byte strings and ids of a byte-level file whose ids are the order of its merges; None for any other file."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    odd = file.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if pattern is None or not plain or odd:
        return None
    rest = [b for b in range(256) if b not in PLAIN_BYTES]
    to_byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"] for t in file.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(vocabulary) != 256 + len(merges):
        return None
    return {bytes(to_byte[c] for c in t): i for t, i in vocabulary.items()}


class Encoder:
    """Ids of texts under a tokenizer file; special tokens are not added, and their names in a text are ordinary text."""

    def __init__(self, content: str, pattern: str | None = None):
        import tokenizers

        self.library = tokenizers.Tokenizer.from_str(content)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        ranks = _ranks(json.loads(content), pattern)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and max(map(len, text.split()), default=0) <= RUN:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(count: int, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the pieces of so many ids: powers of two, none above ``longest``, in falling order."""
    full, rest = divmod(count, longest)
    digits = [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]
    return np.array([longest] * full + digits, np.int64)


PIECES = "doc_id {kind}, start long, length long, doc_tokens long, part int, nth long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, end: int = END, pattern: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``PIECES``: a document's ids from ``start`` on, and the piece's number among those of its length in its task."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("packing", tokenizer, pattern), lambda: Encoder(shared.value, pattern))
        part = TaskContext.get().partitionId()
        seen = np.zeros(longest.bit_length(), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                names, texts = batch.slice(low, ROWS).columns
                parts = [np.append(encoder.ids(t or ""), np.uint32(end)) for t in texts.to_pylist()]
                counts = np.array([len(p) for p in parts], np.int64)
                lists = [cuts(n, longest) for n in counts.tolist()]
                owner = np.repeat(np.arange(len(parts)), [len(x) for x in lists])
                lengths = np.concatenate(lists)
                edges = np.concatenate(([0], np.cumsum(lengths)))
                starts = edges[:-1] - (np.cumsum(counts) - counts)[owner]
                bucket = np.log2(lengths).astype(np.int64)
                nth = np.zeros(len(lengths), np.int64)
                for b in np.unique(bucket).tolist():
                    own = np.flatnonzero(bucket == b)
                    nth[own] = seen[b] + np.arange(len(own))
                    seen[b] += len(own)
                data = pa.py_buffer(np.concatenate(parts).astype("<u4"))
                ids = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(edges * 4), data]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(owner)), *(pa.array(x) for x in (starts, lengths, counts[owner])), pa.array(np.full(len(owner), part, np.int32)), pa.array(nth), ids],
                    names=["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"],
                )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(make, PIECES.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def packed(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    The bucket of a sequence is its length.
    """
    cut = stored(pieces(docs, tokenizer, **options), compression="zstd")
    counts = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    totals = sorted(((r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()), reverse=True)  # a row per power of two
    first, start = F.lit(0).cast("long"), 0
    for length, n in totals:
        first = F.when(F.col("length") == length, F.lit(start).cast("long")).otherwise(first)
        start += n
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", (first + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("base"))
    placed = cut.join(lookup(bases, counts.count()), ["length", "part"])
    return placed.select("doc_id", "start", "length", "doc_tokens", (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
