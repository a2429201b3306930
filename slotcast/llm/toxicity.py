"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words in lower case and their first four to six letters, each hashed to one of 2^20
buckets. Single terms get a weight, pairs of terms the product of two short vectors, so that a pair such as an insult
beside a group's name can count for more than its parts. Training is on a bounded, documented sample of labelled rows
(``per_class`` of either label by a hash of the id), by gradient steps (Adam) in numpy on the driver; the bias is set back
to the labels' true shares. The machine holds every bucket that tells the labels apart alone (chi-square above ``ALONE``),
and every one of the ``FREQUENT`` most frequent buckets that does so together with another (their joint deviation from
what either says is more than ``TOGETHER`` standard deviations), however many these are; a text given several times counts
once in these statistics. Scoring needs one small table and no shuffle.

Null and empty texts, and texts without a known term, get the score of the bias. Labels that are null or neither 0 nor
1 don't train; without both labels every score is the share of label 1 (0 without labels). Rows keep their number;
columns but key and text are not read when scoring.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import only

BUCKETS, VECTOR, SEED = 1 << 20, 6, 11
WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
KEPT_WORDS = 400_000
ALONE, TOGETHER, FREQUENT = 25.0, 6.5, 2048


def word_terms(word: str) -> list[int]:
    """Buckets of one word's terms."""
    import xxhash

    return [xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) % BUCKETS for t in ("=" + word, *(f"{n}^{word[:n]}" for n in PREFIXES if len(word) >= n))]


class Machine:
    """Bias, weights and vectors of the kept buckets."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray, places: dict[int, int]):
        self.bias, self.weights, self.vectors, self.places = bias, weights, vectors, places
        self.words: dict[str, tuple[int, ...]] = {}

    def known(self, text: str) -> list[int]:
        """Places of the text's kept terms, ascending."""
        found: set[int] = set()
        kept = self.words
        for word in set(WORD.findall(text.lower())):
            own = kept.get(word)
            if own is None:
                if len(kept) > KEPT_WORDS:
                    kept.clear()
                own = kept[word] = tuple(self.places[t] for t in word_terms(word) if t in self.places)
            found.update(own)
        return sorted(found)

    def score(self, text: str | None) -> float:
        z, at = self.bias, self.known(text or "")
        if at:
            v = self.vectors[at]
            z += float(self.weights[at].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v**2).sum()))
        return round(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), 6)


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Buckets that tell the labels apart, alone or in pairs, ascending."""
    distinct = {(r.tobytes(), int(y)): i for i, (r, y) in enumerate(zip(rows, labels))}
    rows, labels = [rows[i] for i in distinct.values()], labels[list(distinct.values())]
    buckets, entry = np.unique(np.concatenate(rows), return_inverse=True)
    sizes = [len(r) for r in rows]
    count, share = len(rows), float(labels.mean())
    if not len(buckets) or share in (0.0, 1.0):
        return buckets[:0]
    total, ones = np.bincount(entry, minlength=len(buckets)), np.bincount(entry, np.repeat(labels, sizes), len(buckets))
    alone = (total >= 3) & ((ones - total * share) ** 2 > ALONE * total * share * (1 - share))
    often = total / count
    top = np.argsort(-often * (1 - often), kind="stable")[:FREQUENT]
    place = np.full(len(buckets), -1)
    place[top] = np.arange(len(top))
    p = often[top].astype(np.float32)
    both, joint = (np.zeros((len(top), len(top)), np.float32) for _ in range(2))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    for low in range(0, count, 512):  # central moments of two terms, and of two terms and the label
        high = min(low + 512, count)
        at = place[entry[edges[low] : edges[high]]]
        owner = np.repeat(np.arange(high - low), sizes[low:high])
        x = np.zeros((high - low, len(top)), np.float32)
        x[owner[at >= 0], at[at >= 0]] = 1
        x -= p
        both += x.T @ x
        joint += x.T @ (x * (labels[low:high] - share).astype(np.float32)[:, None])
    both /= count
    spread = p * (1 - p)
    variance = np.outer(1 - 2 * p, 1 - 2 * p) * both
    variance += np.outer(spread, spread)
    variance -= both**2
    variance = np.maximum(variance, 1e-9, out=variance) * np.float32(count * share * (1 - share))
    rare = np.outer(p, p) * count * share * (1 - share) < 5
    alike = np.abs(both) > 0.5 * np.sqrt(np.outer(spread, spread))  # a word and its beginning
    paired = ((joint**2 > TOGETHER**2 * variance) & ~rare & ~alike).any(axis=1)
    alone[top[paired]] = True
    return buckets[alone]


def train(rows: list[np.ndarray], labels: np.ndarray, share: float, steps: int = 500) -> Machine:
    """``rows``: distinct buckets of each text; ``share``: of label 1 among all labelled rows."""
    one, zero = int(labels.sum()), int(len(labels) - labels.sum())
    if not one or not zero:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, VECTOR)), {})
    best = telling(rows, labels)
    index = np.full(BUCKETS, -1, np.int32)
    index[best] = np.arange(len(best))
    lists = [index[r] for r in rows]
    lists = [at[at >= 0] for at in lists]
    sizes = np.array([len(at) for at in lists])
    edges, entry = np.concatenate(([0], np.cumsum(sizes))), np.concatenate(lists)
    rng = np.random.default_rng(SEED)
    y = labels.astype(np.float32)
    parts = [np.zeros(1, np.float32), np.zeros(len(best), np.float32), rng.normal(0, 0.02, (len(best), VECTOR)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    batch = 512
    step = 0
    for _ in range(max(1, steps * batch // max(len(rows), batch)) + 4):
        order = rng.permutation(len(rows))
        for low in range(0, len(rows), batch):
            pick = order[low : low + batch]
            own, ends = sizes[pick], np.cumsum(sizes[pick])
            terms = entry[np.repeat(edges[pick] - ends + own, own) + np.arange(ends[-1])]
            owner = np.repeat(np.arange(len(pick)), own)
            b, w, v = parts
            vx = v[terms]
            s = _summed(owner, vx, len(pick))
            z = b[0] + np.bincount(owner, w[terms], len(pick)) + 0.5 * ((s**2).sum(axis=1) - np.bincount(owner, (vx**2).sum(axis=1), len(pick)))
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)).astype(np.float32)
            gx = g[owner]
            grads = [np.array([g.sum()], np.float32), np.bincount(terms, gx, len(best)) + 1e-4 * w, _summed(terms, gx[:, None] * (s[owner] - vx), len(best)) + 1e-3 * v]
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                parts[k] = parts[k] - 0.03 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    share = min(max(share, 1e-6), 1 - 1e-6)
    bias = float(parts[0][0]) + float(np.log(share / (1 - share)) - np.log(one / zero))
    return Machine(bias, parts[1].astype(float), parts[2].astype(float), {int(t): i for i, t in enumerate(best)})


def _summed(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows of ``values`` by owner."""
    return np.stack([np.bincount(owner, values[:, k], count) for k in range(values.shape[1])], axis=1).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> Machine:
    """Trains on documents (doc_id, text) with labels (doc_id, toxic): at most ``per_class`` of either label."""
    labels = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return train([], np.zeros(0, int), 0.0)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(1 << 40))
    # The rate leaves a little over the bound; the rest is cut off below by the same hash.
    rate = {k: int(min(1.0, (per_class * 1.2 + 20) / n) * (1 << 40)) for k, n in counts.items()}
    chosen = labels.withColumn("place", place).where(F.col("place") < F.when(F.col("toxic") == 1, rate.get(1, 0)).otherwise(rate.get(0, 0)))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                found: set[int] = set()
                for word in set(WORD.findall((text or "").lower())):
                    own = seen.get(word)
                    if own is None:
                        if len(seen) > KEPT_WORDS:
                            seen.clear()
                        own = seen[word] = word_terms(word)
                    found.update(own)
                out.append(sorted(found))
            packed = pa.array([np.array(x, "<i4").tobytes() for x in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "terms"])

    texts = only(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chosen)
    # Terms stay in Arrow buffers; the arrays below are views of them.
    rows = texts.mapInArrow(terms, "doc_id long, terms binary").join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id").toArrow()
    rows = rows.sort_by([("place", "ascending"), ("doc_id", "ascending")])
    said = rows["toxic"].to_numpy()
    picked = np.concatenate([np.flatnonzero(said == k)[:per_class] for k in (0, 1)])
    share = counts.get(1, 0) / sum(counts.values())
    return train([np.frombuffer(rows["terms"][int(i)].as_buffer(), "<i4") for i in picked], said[picked].astype(int), share)


def scores(docs: DataFrame, machine: Machine, key: str = "doc_id") -> DataFrame:
    """Rows (key, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # the terms of a bounded sample that tell

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shared.value.score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=[key, "score"])

    rows = docs.select(key, "text")
    return rows.mapInArrow(make, f"{key} {rows.schema[key].dataType.simpleString()}, score double")
