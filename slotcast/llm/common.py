"""Shared pieces of the text operators: reading, intermediate tables, Arrow batches and word hashes."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import configure, ensure_checkpoint_dir

# Bytes of text that a task turns into arrays at a time; bounds its memory, not its input.
SLICE_BYTES = 1 << 20
ARROW_ROWS, ARROW_BYTES = "1000", "8m"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches, so long texts don't pile up in a worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _kept() -> dict:
    """What ``per_worker`` keeps: one table per Python worker, by key."""
    return sys.modules.setdefault("_slotcast_worker", types.ModuleType("_slotcast_worker")).__dict__.setdefault("kept", {})


def per_worker(key, make):
    """What ``make`` returns, made once in each Python worker and kept there for its later tasks.

    Only the last one asked for is kept: workers outlive an operator, and the next one's tasks need the room.
    """
    kept = _kept()
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def returned() -> None:
    """Memory that a task has freed goes back to the system: workers stay, with all that their allocators hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def let_go(key=None) -> None:
    """A worker drops what other operators keep there: of ``per_worker`` only ``key`` stays."""
    kept = _kept()
    others = [k for k in kept if k != key]
    for other in others:
        del kept[other]
    if others:
        returned()


def frugal(make: Callable, key=None) -> Callable:
    """``make`` for mapInArrow, in workers that hold nothing of other operators, before and after the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(key)
        yield from make(batches)
        returned()

    return run


def stored(df: DataFrame, **options) -> DataFrame:
    """Writes a table to the folder that all executors share and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes together; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, min(end, n)
        start = min(end, n)


# Weyl step and multipliers of the splitmix64 finaliser.
STEP, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x + np.uint64(STEP)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 bytes, all words of a slice at once.

    A word's hash is a polynomial in its bytes, got from running sums: the sum up to the word's end less the sum up
    to its start, brought back to power 0. ``lower`` maps A-Z to a-z first.
    """

    def __init__(self, lower: bool = False, seed: int = 1):
        rng = np.random.default_rng(seed)
        table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            table[65:91] = table[97:123]
        self.table = table
        base = int(rng.integers(2**40, 2**62)) * 8 + 5
        self.base, self.inverse = base % 2**64, pow(base, -1, 2**64)
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.powers = self.inverses = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            ones = np.full(max(n, SLICE_BYTES + 1), self.base, np.uint64)
            ones[0] = 1
            self.powers = np.cumprod(ones, dtype=np.uint64)
            ones[1:] = self.inverse
            self.inverses = np.cumprod(ones, dtype=np.uint64)

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts of the words of one run of bytes."""
        word = ~self.space[data]
        edge = np.diff(np.concatenate(([False], word, [False])).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], dtype=np.uint64, out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts]), starts

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all rows, and the number of words before each row (one more entry than rows).

        Rows must not run into each other: a row's last and the next row's first word count apart.
        """
        h, at = self.words_at(data, offsets)
        return h, np.searchsorted(at, offsets, "left")

    def words_at(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all rows, and the places of the words' first bytes."""
        low, high = int(offsets[0]), int(offsets[-1])
        hashes, places = [], []
        cut = low
        while cut < high:
            end = min(cut + SLICE_BYTES, high)
            if end < high:
                inside = offsets[(offsets > cut) & (offsets <= end)]
                if len(inside):
                    end = int(inside[-1])
                else:  # one long row: cut it after white space, or where its next word ends
                    gap = np.flatnonzero(self.space[data[cut:end]])
                    stop = int(offsets[np.searchsorted(offsets, cut, "right")])
                    if len(gap):
                        end = cut + int(gap[-1]) + 1
                    else:
                        while end < stop and not self.space[data[end]]:
                            end += 1
            piece = data[cut:end]
            inner = offsets[(offsets > cut) & (offsets < end)] - cut
            if len(inner):  # a separator between rows
                piece = np.insert(piece, inner, 32)
            h, at = self._piece(piece)
            if len(inner):
                at = at - np.searchsorted(inner + np.arange(len(inner)), at, "left")
            hashes.append(h)
            places.append(at + cut)
            cut = end
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        return h, at


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes; runs that cross rows are the caller's to skip."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    weight = 1
    for i in range(n):
        weight = weight * 0xD1342543DE82EF95 % 2**64
        total += words[i : i + count] * np.uint64(weight)
    return mixed(total)


# Rows of one or two ids that may be broadcast (about 40 bytes each in memory) where their number was counted first;
# more are joined by shuffle, with the same result.
BROADCAST_IDS = 2_000_000


def lookup(ids: DataFrame, count: int | None = None) -> DataFrame:
    """A narrow table to join with: broadcast if it was counted and is small."""
    return F.broadcast(ids) if (ids.count() if count is None else count) <= BROADCAST_IDS else ids


def only(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose doc_id is (left_semi) or isn't (left_anti) in ``ids``: wide rows stay where they are if ids are few."""
    return rows.join(lookup(ids.select("doc_id")), "doc_id", how)


def contracted_labels(edges: DataFrame) -> DataFrame:
    """``least_labels`` of many edges (a < b): first along one edge of each node, then among what is left."""
    kept = least_labels(edges.groupBy("b").agg(F.min("a").alias("a")))
    # A node that is never a b and no b's least a stands on none of the edges kept; it is labelled by itself.
    alone = edges.select(F.col("a").alias("node")).distinct().join(lookup(kept.select("node")), "node", "left_anti")
    first = stored(kept.select("node", "label").union(alone.select("node", F.col("node").alias("label"))))
    count = first.count()
    up = lambda side: lookup(first.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label")), count)
    rest = stored(
        edges.join(up("a"), "a").join(up("b"), "b").where("a_label <> b_label")
        .select(F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b")).distinct()
    )
    if not rest.limit(1).count():
        return first
    second = least_labels(rest).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return stored(first.join(lookup(second), "label", "left").select("node", F.coalesce("least", "label").alias("label")))


def least_labels(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, label), label the least node reachable.

    Least labels spread along the edges and jump to the label of their label each round, so rounds grow with the
    logarithm of a component's width. Every round is a stored table; nothing is gathered.
    """
    both = stored(edges.select("a", "b").where("a <> b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    count = labels.count()
    while count:
        near = both.join(lookup(labels.select(F.col("node").alias("b"), "label"), count), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = near.join(lookup(labels, count), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = stored(spread.join(lookup(up, count), "label").select("node", "was", F.least("label", "up").alias("label")))
        labels = moved.select("node", "label")
        if not moved.where("label <> was").limit(1).count():
            break
    return labels
