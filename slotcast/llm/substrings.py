"""Substring dedup by seed and extend.

Windows of ``window`` consecutive words are what repeats are judged by; maximal repeats are runs of such windows. Seeds
are winnowed anchors: of the ``anchor``-word runs inside a window the one with the least hash (the last of equals), so
equal windows have equal anchors, and consecutive windows mostly share theirs. Windows with the same anchor form a
segment: the anchor extended both ways. Segments are joined on their anchor:

1. A segment whose anchor and content occurred earlier is repeated as a whole (copies inside one batch are settled before
   the shuffle, so a passage in many documents is not one hot key).
2. Anchors that several different segments share are extended word by word: the first segment of each content gives its
   windows, which are joined on content.

A window is repeated if the same words also start earlier (smaller id, or same document and earlier start), judged on
the input. Content is compared by two independent 64-bit hashes (of anchor and segment or window). A document's repeated
windows cover the words that are removed.

Null, empty and short texts have no window. A row without an id neither removes nor loses words. Rows with equal ids are
told apart by a hash of their texts; a window at the same place of the same id isn't earlier than itself, so rows given
twice lose nothing by each other. Columns but id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import WordHasher, bytes_of, grams, slices, stored

WINDOW, ANCHOR = 20, 8


def segments_of(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, content hash, start and number of windows of each segment of one text."""
    count = len(words) - window + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = grams(words, anchor)
    span = window - anchor + 1
    # Position of the least key of every window: halves of growing runs, the later of equals.
    best, length = np.arange(len(keys)), 1
    while length < span:
        shift = min(length, span - length)
        a, b = best[:-shift], best[shift:]
        best = np.where(keys[b] <= keys[a], b, a)
        length += shift
    starts = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
    sizes = np.diff(np.concatenate((starts, [count])))
    place = best[starts]
    # Content: weighted sum of the segment's words, by running sums; the weight of a word depends on its place in it.
    base = 0x9E6C63D0876A9A47
    powers, inverse = np.full(len(words) + 1, base, np.uint64), np.full(len(words) + 1, pow(base, -1, 2**64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[:-1], dtype=np.uint64)))
    ends = starts + sizes + window - 1
    shape = (place - starts).astype(np.uint64) * np.uint64(1 << 20) + sizes.astype(np.uint64)
    content = ((sums[ends] - sums[starts]) * inverse[starts]) * np.uint64(0xD6E8FEB86659FD93) + shape * np.uint64(0xA0761D6478BD642F)
    return keys[place], content, starts, sizes


SEGMENTS = "doc_id long, row long, start int, size int, anchor long, content long, again boolean"
ROW = ["doc_id", "row"]


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with an id, and a hash of the text that tells rows of equal ids apart."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.withColumn("row", F.xxhash64("text"))


def _not_first(*by: str):
    """Whether the same content starts at an earlier place (not merely at the same place of a row given twice)."""
    place = F.struct("doc_id", "start")
    return F.first(place).over(Window.partitionBy(*by).orderBy("doc_id", "start")) < place


def segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Rows of ``SEGMENTS``; ``again`` marks a segment that occurred earlier in the same batch of documents.

    Such a row's key is made its own, so that rows of a hot passage do not meet in one task.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=2)
        for batch in batches:
            data, offsets = bytes_of(batch.column(2))
            ids, rows = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            for low, high in slices(offsets, 4 << 20):
                words, before = hasher.words(data, offsets[low : high + 1])
                parts = [segments_of(words[a:b], window, anchor) for a, b in zip(before[:-1], before[1:])]
                counts = [len(p[0]) for p in parts]
                owner, row = np.repeat(ids[low:high], counts), np.repeat(rows[low:high], counts)
                keys, content, starts, sizes = (np.concatenate([p[k] for p in parts]) for k in range(4))
                order = np.lexsort((starts, owner, content, keys))
                k, c, o, at = keys[order], content[order], owner[order], starts[order]
                new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))[: len(order)]
                first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                again = np.zeros(len(order), bool)
                again[order] = (o != o[first]) | (at != at[first])
                keys = np.where(again, (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + starts.astype(np.uint64), keys)
                content = np.where(again, np.uint64(0), content)
                yield pa.RecordBatch.from_arrays([
                    pa.array(owner), pa.array(row), pa.array(starts.astype(np.int32)), pa.array(sizes.astype(np.int32)),
                    pa.array(keys.view(np.int64)), pa.array(content.view(np.int64)), pa.array(again),
                ], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return docs.select("doc_id", "row", "text").mapInArrow(make, SEGMENTS)


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Rows (doc_id, row, spans): an array of struct(start, size) of the repeated windows, for documents that have any."""
    docs = _rows(docs).where("doc_id is not null")
    of_anchor = Window.partitionBy("anchor")
    marked = segments(docs, window, anchor).withColumns({
        "again": F.col("again") | _not_first("anchor", "content"), "edge": F.min("content").over(of_anchor) < F.max("content").over(of_anchor),
    })
    whole = stored(marked.where("again or edge").select(*ROW, "start", "size", "again"))
    return _extended(docs, whole, window, anchor)


def _extended(docs: DataFrame, rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """Repeats of ``rows``: whole segments, and the windows of segments whose anchor others share."""
    shared = rows.where("not again").select(*ROW, "start", "size")
    lists = shared.groupBy(*ROW).agg(F.collect_set(F.struct("start", "size")).alias("spans"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(seed=2)
        other = WordHasher(seed=3)
        for batch in batches:
            data, offsets = bytes_of(batch.column(2))
            ids, hashes, spans = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for low, high in slices(offsets):
                words, before = hasher.words(data, offsets[low : high + 1])
                words2, _ = other.words(data, offsets[low : high + 1])
                owner, row, start, first, second = [], [], [], [], []
                for k in range(low, high):
                    a, b = before[k - low], before[k - low + 1]
                    one, two = grams(words[a:b], window), grams(words2[a:b], window)
                    at = np.concatenate([np.arange(s["start"], s["start"] + s["size"]) for s in spans[k]])
                    owner.append(np.full(len(at), ids[k], np.int64))
                    row.append(np.full(len(at), hashes[k], np.int64))
                    start.append(at.astype(np.int32))
                    first.append(one[at].view(np.int64))
                    second.append(two[at].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (owner, row, start, first, second)], names=[*ROW, "start", "first", "second"])

    windows = docs.join(lists, ROW).select(*ROW, "text", "spans").mapInArrow(make, "doc_id long, row long, start int, first long, second long")
    later = windows.withColumn("late", _not_first("first", "second")).where("late").select(*ROW, "start", F.lit(1).alias("size"))
    found = rows.where("again").select(*ROW, "start", "size").union(later)
    return found.groupBy(*ROW).agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def covered(count: int, spans: list[dict], window: int) -> np.ndarray:
    """Which of ``count`` words the repeated windows cover."""
    steps = np.zeros(count + 1, np.int64)
    starts = np.array([s["start"] for s in spans], np.int64)
    ends = starts + np.array([s["size"] for s in spans], np.int64) + window - 1
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words that stay, joined by blanks)."""
    spans = repeats(docs, window, anchor)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode().split()  # bytes split at the six white-space bytes
                n_words.append(len(words))
                if found:
                    gone = covered(len(words), found, window)
                    n_removed.append(int(gone.sum()))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return _rows(docs).join(spans, ROW, "left").select("doc_id", "text", "spans").mapInArrow(make, "doc_id long, n_words long, n_removed long, kept string")
