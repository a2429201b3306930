"""Ranked lexical search: exact inner products of sparse vectors over ball trees.

A text's terms are the maximal runs of letters and digits (``[0-9A-Za-z]`` and everything beyond ASCII), only A-Z
lower-cased. A document's vector holds weight times impact of each of its terms (integers, ``weight`` and ``impact``
below), an item's vector a 1 for each of its terms; the score is their inner product. Documents are kept on the items'
terms alone, which changes no product.

1. One pass counts the terms of every document; sums over it give N, L and the document frequencies of the items' terms.
2. Documents are taken in blocks (``BLOCK_ROWS`` rows, ``BLOCK_ENTRIES`` entries, whatever comes first). A block becomes a
   ball tree: every node has the centroid c of its documents, their greatest distance r from it, and their greatest
   distance along each single term; it is split between two documents far from each other, down to leaves of ``LEAF``
   documents. An item q is at most ``q.c + |q| r`` from a node's documents, and at most the sum of centroid and distance
   over its terms; the lower of the two is the bound. (On prose the first alone prunes nothing: documents are nearly
   orthogonal, so radii are as long as the documents.) Bounds are computed in doubles and raised by more than rounding
   can have taken, so none is too low.
3. For each item nodes are visited best bound first, until the bound is below the item's k-th score so far; leaves are
   scored in integers. A task carries the best k of each item from block to block, and hands on k rows an item.

Items are searched in blocks of about ``ITEM_ENTRIES`` terms, so what is broadcast has a bound of its own.

Null and empty texts, and texts without a term, count nowhere. Equal scores rank by ascending id; rows with equal ids are
documents of their own, rows without an id count in the statistics but aren't ranked. Rows of ``items`` with equal ids are
one item that holds the terms of all of them. Items without a scoring document, and empty tables, give no rows. Columns
besides id and text are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

BLOCK_ROWS, BLOCK_ENTRIES, LEAF = 2048, 1 << 20, 8
ITEM_ENTRIES = 200_000
PIECE = 1 << 22  # bytes split into terms at a time
ROUNDING = 2.0**-50  # rounding of one operation, with room to spare

# Bytes of terms stay (A-Z lower-cased), all others become blanks.
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """How often each term occurs; long texts are split piece by piece."""
    found: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + PIECE
        piece = text[start:end].translate(_KEEP)
        if end < len(text):  # end after a blank, or read on to the next one
            cut = piece.rfind(b" ") + 1
            while not cut and end < len(text):
                end += PIECE
                piece += text[end - PIECE : end].translate(_KEEP)
                cut = piece.find(b" ") + 1
            if cut:
                end = start + cut
                piece = piece[:cut]
        found.update(piece.split())
        start = end
    return found


def weight(df: np.ndarray, documents: int) -> np.ndarray:
    """Weight of terms held by ``df`` of so many documents."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * np.asarray(df, np.float64) + 1))).astype(np.int64)


def length_part(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a document's length adds to the divisor of its impacts, in a corpus of so many documents and terms."""
    return np.array([10 + (90 * k * documents) // terms for k in n.tolist()], np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Impact of terms that occur ``tf`` times in documents of length part ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Rows:
    """Sparse rows: entries of row i stand at ``edges[i]`` to ``edges[i + 1]``. No row is empty."""

    def __init__(self, edges: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.edges, self.terms, self.values = edges, terms, values

    def __len__(self) -> int:
        return len(self.edges) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = self.edges[rows + 1] - self.edges[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.edges[rows] - ends + sizes, sizes) + np.arange(ends[-1])
        return Rows(np.concatenate(([0], ends)), self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.terms], self.edges[:-1])


class BallTree:
    """Nodes with a bound for each item; ``leaves`` maps a leaf's node to the positions of its documents."""

    def __init__(self, rows: Rows, items: Rows, width: int, leaf: int = LEAF):
        self.items, self.width, self.leaf = items, width, leaf
        self.norms = np.sqrt(np.diff(items.edges).astype(np.float64))
        self.bounds: list[np.ndarray] = []
        self.children: dict[int, tuple[int, int]] = {}
        self.leaves: dict[int, np.ndarray] = {}
        self._grow(Rows(rows.edges, rows.terms, rows.values.astype(np.float64)), np.arange(len(rows)), None)

    def _grow(self, rows: Rows, places: np.ndarray, above: np.ndarray | None) -> int:
        node = len(self.bounds)
        squares = np.add.reduceat(rows.values**2, rows.edges[:-1])
        centre = np.bincount(rows.terms, rows.values, self.width) / len(rows)
        size, dots = float(centre @ centre), rows.dot(centre)
        apart = squares - 2 * dots + size
        # No value is negative, so errors are relative to the sums of what is added.
        slack = (len(rows.terms) + len(self.items.terms) + self.width + 8) * ROUNDING
        radius = np.sqrt(max(float((apart + slack * (squares + 2 * dots + size)).max()), 0.0)) * (1 + slack)
        ball = self.items.dot(centre) + self.norms * radius
        along = np.zeros(self.width)  # centroid and greatest distance along each term
        np.maximum.at(along, rows.terms, rows.values)
        bound = np.minimum(ball, self.items.dot(along)) * (1 + slack) + 1
        self.bounds.append(bound if above is None else np.minimum(bound, above))
        if len(rows) <= self.leaf:
            self.leaves[node] = places
            return node
        first = rows.dot(self._dense(rows, int(apart.argmax())))
        second = rows.dot(self._dense(rows, int((squares - 2 * first).argmax())))
        order = np.argsort(first - second, kind="stable")
        halves = order[: len(order) // 2], order[len(order) // 2 :]
        self.children[node] = tuple(self._grow(rows.take(h), places[h], self.bounds[node]) for h in halves)
        return node

    def _dense(self, rows: Rows, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        own = slice(rows.edges[row], rows.edges[row + 1])
        out[rows.terms[own]] = rows.values[own]
        return out

    def search(self, item: int, least, score) -> int:
        """Scores leaves, best bound first, while the bound reaches ``least()``; returns how many leaves were scored."""
        heap, visited = [(-self.bounds[0][item], 0)], 0
        while heap and -heap[0][0] >= least():
            _, node = heapq.heappop(heap)
            if node in self.leaves:
                score(self.leaves[node], node)
                visited += 1
            else:
                for child in self.children[node]:
                    heapq.heappush(heap, (-self.bounds[child][item], child))
        return visited


class Search:
    """The best ``k`` documents of each item over the blocks seen so far."""

    def __init__(self, items: Rows, width: int, k: int):
        self.items, self.width, self.k = items, width, k
        self.scores, self.ids = [np.zeros(0, np.int64)] * len(items), [np.zeros(0, np.int64)] * len(items)
        self.least = np.ones(len(items), np.int64)  # a score must be above 0
        self.leaves_scored = self.leaves_seen = 0

    def add(self, ids: np.ndarray, rows: Rows) -> None:
        tree = BallTree(rows, self.items, self.width)
        dense = np.zeros(self.width, np.int64)
        parts: dict[int, Rows] = {}
        self.leaves_seen += len(tree.leaves) * len(self.items)
        for item in np.flatnonzero(tree.bounds[0] >= self.least).tolist():
            own = self.items.terms[self.items.edges[item] : self.items.edges[item + 1]]
            dense[own] = 1

            def score(places: np.ndarray, leaf: int) -> None:
                if leaf not in parts:
                    parts[leaf] = rows.take(places)
                self._merge(item, parts[leaf].dot(dense), ids[places])

            self.leaves_scored += tree.search(item, lambda: self.least[item], score)
            dense[own] = 0

    def _merge(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least[item]
        if not good.any():
            return
        scores, ids = np.concatenate((self.scores[item], scores[good])), np.concatenate((self.ids[item], ids[good]))
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[item], self.ids[item] = scores[best], ids[best]
        if len(best) == self.k:
            self.least[item] = scores[best[-1]]


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Rows (id, n, terms, counts) of documents with a term: all their terms, and which of the vocabulary's how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most about ITEM_ENTRIES terms

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, terms, counts = [], [], [], []
            for id_, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = term_counts(data or b"")
                if found:
                    own = sorted((known[t], c) for t, c in found.items() if t in known)
                    ids.append(id_)
                    sizes.append(found.total())
                    terms.append([t for t, _ in own])
                    counts.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(make, "id long, n long, terms array<int>, counts array<long>")


def _best(counted: DataFrame, items: Rows, names: pa.Array, kind: str, df: np.ndarray, documents: int, terms: int, k: int) -> DataFrame:
    """Rows (item_id, doc_id, score): the best k documents of each item within each task."""
    shared = counted.sparkSession.sparkContext.broadcast((items, weight(df, documents), names))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, labels = shared.value
        search = Search(queries, len(weights), k)
        waiting: list[tuple] = []
        held = rows = 0

        def flush() -> None:
            ids, sizes, own, values = (np.concatenate(x) for x in zip(*waiting))
            search.add(ids, Rows(np.concatenate(([0], np.cumsum(sizes))), own, values))

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                ids, n, lists, counts = batch.slice(start, 256).columns
                sizes, own, tf = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), counts.flatten().to_numpy()
                values = weights[own] * impact(tf, np.repeat(length_part(n.to_numpy(), documents, terms), sizes))
                waiting.append((ids.to_numpy(), sizes, own, values))
                held, rows = held + len(own), rows + len(sizes)
                if held >= BLOCK_ENTRIES or rows >= BLOCK_ROWS:
                    flush()
                    waiting.clear()
                    held = rows = 0
        if waiting:
            flush()
        at = np.repeat(np.arange(len(queries)), [len(s) for s in search.scores])
        yield pa.RecordBatch.from_arrays(
            [labels.take(pa.array(at)), pa.array(np.concatenate(search.ids)), pa.array(np.concatenate(search.scores))], names=["item_id", "doc_id", "score"]
        )

    # Documents without any of the items' terms score 0.
    return counted.where("id is not null and size(terms) > 0").mapInArrow(make, f"item_id {kind}, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
           item_entries: int = ITEM_ENTRIES) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: rows (item_id, rank, doc_id, score), best first."""
    spark, kind = docs.sparkSession, items.schema[item_key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(term_counts(t or b"")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    pairs = items.select(F.col(item_key).alias("item_id"), F.col(text).cast("binary")).mapInArrow(split, f"item_id {kind}, terms array<binary>")
    pairs = stored(pairs.select("item_id", F.explode("terms").alias("term")).distinct())
    blocks = -(-pairs.count() // item_entries)
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).toArrow()
        if not own.num_rows:
            continue
        lists = own["terms"].combine_chunks()
        words = lists.flatten().dictionary_encode()
        queries = Rows(lists.offsets.to_numpy().astype(np.int64), words.indices.to_numpy(), np.ones(len(words)))
        counted = stored(_counted(docs, {t: i for i, t in enumerate(words.dictionary.to_pylist())}, key, text))
        documents, terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        df = np.zeros(len(words.dictionary), np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms
            df[term] = n
        found = found.unionByName(_best(counted, queries, own["item_id"].combine_chunks(), kind, df, documents, terms, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
