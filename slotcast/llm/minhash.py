"""Near-duplicate documents through SetSketch registers.

A document's set holds the hashes of its word shingles. Its sketch keeps, for each of 512 registers, the truncated
logarithm of the least of exponentially spaced values (register values of two sets agree with a chance close to their
Jaccard similarity; the sketch of a union is the registerwise maximum). Bands of registers propose pairs, whose
similarity is estimated jointly by likelihood from how many registers are greater, equal and smaller, given the known
set sizes; pairs that may reach the threshold are confirmed on their full sets.

Equal sets are one class from the start, so copies never meet pairwise. Classes that share a band join a candidate
group by their least member, which takes as many links as members. A group up to ``block`` classes is settled in one
task: pairs in order of estimate, skipping those already connected, each confirmed on full sets. A larger group is
split into blocks by a hash of the id: blocks are settled alone, then the centres of the blocks (again in blocks, until
one is left). At last the classes outside the group's largest component are dealt into blocks of their own, as are the
others, and every such block is held against itself and every other block, each two blocks in one task: no task holds
more than about ``block`` classes, however many lie outside. No pair of different components that passes the estimate
stays unconfirmed.

Nulls, empty and blank texts have an empty set, linked with nothing. Fewer words than a shingle count as one shingle.
Ids must be unique; equal texts are one class. A row without an id links with nothing and isn't kept. Columns of the input
other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHasher, bytes_of, contracted_labels, frugal, grams, least_labels, let_go, lookup, mixed, only, slices, stored

REGISTERS, BANDS, BAND_ROWS = 512, 64, 8
BASE, SCALE, TOP = 1.001, 20.0, 65534
BLOCK = 1024
# Bytes of text turned into sets at a time: the arrays of words and shingles are many times as large.
TEXT_BYTES = 1 << 18
# Standard errors of the estimate below the threshold at which a pair is still confirmed.
MARGIN = 4.5
FEATURES = "doc_id long, n_shingles long, set_key binary, sketch binary"


def shingle_sets(words: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and the offsets of the rows."""
    all_grams = grams(words, n)
    parts = []
    for low, high in zip(before[:-1].tolist(), before[1:].tolist()):
        if high - low >= n:
            g = np.sort(all_grams[low : high - n + 1])
            parts.append(g[np.concatenate(([True], g[1:] != g[:-1]))])
        elif high > low:
            parts.append(grams(words[low:high], high - low) ^ np.uint64(high - low))
        else:
            parts.append(np.zeros(0, np.uint64))
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def sketches(elements: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Registers of every row (rows x m, uint16).

    An element's values ascend, the j-th being the j-th least of m exponential ones, and visit the registers in an
    order of its own. An element drops out once its value exceeds all minima of its row.
    """
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    least = np.full((rows, m), np.inf)
    flat = least.reshape(-1)
    row, h = np.repeat(np.arange(rows), sizes), elements
    place = mixed(h ^ np.uint64(0x5851F42D4C957F2D))
    first = (place & np.uint64(m - 1)).astype(np.int64)
    step = ((place >> np.uint64(20)) & np.uint64(m - 1)).astype(np.int64) | 1
    value = np.zeros(len(h))
    for j in range(m):
        uniform = ((mixed(h + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        value = value - np.log(uniform) / (m - j)
        np.minimum.at(flat, row * m + ((first + j * step) & (m - 1)), value)
        alive = value < least.max(axis=1)[row]
        if not alive.all():
            row, h, first, step, value = row[alive], h[alive], first[alive], step[alive], value[alive]
        if not len(h):
            break
    with np.errstate(divide="ignore"):
        levels = np.floor(1.0 - np.log(least * (1.0 / SCALE)) / np.log(BASE))
    # Least values lie around 1/size; the offset puts sets of one to 10^18 elements inside the 16 bits.
    return np.clip(np.where(np.isfinite(levels), levels + 5000, 0), 0, TOP).astype(np.uint16)


def features(docs: DataFrame, n: int, lower: bool) -> DataFrame:
    """Rows (doc_id, n_shingles, set_key, sketch): one pass over the texts, no shuffle."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower)
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for low, high in slices(offsets, TEXT_BYTES):
                words, before = hasher.words(data, offsets[low : high + 1])
                elements, at = shingle_sets(words, before, n)
                rows = sketches(elements, at)
                keys = []
                for a, b in zip(at[:-1], at[1:]):
                    part = elements[a:b]
                    keys.append(np.array([part.sum(dtype=np.uint64), mixed(part ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)]).tobytes() if b > a else None)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low).cast(pa.int64()), pa.array(np.diff(at)),
                    pa.array(keys, pa.binary()), pa.array([r.tobytes() for r in rows], pa.binary()),
                ], names=["doc_id", "n_shingles", "set_key", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(frugal(make), FEATURES)


def candidate_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) between each class and the least class of every band value it shares with another."""
    width = 2 * BAND_ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sketch", 1 + i * width, width)) for i in range(BANDS)])
    rows = classes.select("doc_id", F.explode(bands).alias("band"))
    shared = rows.groupBy("band").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").select("band", "a")
    return rows.join(shared, "band").where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()


def may_reach(equal: np.ndarray, greater: np.ndarray, size_a: float, size_b: np.ndarray, similarity: float, m: int = REGISTERS) -> np.ndarray:
    """Whether the joint likelihood of the register counts still rises at the threshold less its margin.

    The likelihood is concave in the similarity, so then and only then does its maximum lie above.
    """
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    j = np.minimum(similarity - MARGIN * np.sqrt(similarity * (1 - similarity) / m), np.minimum(u / v, v / u) * 0.999)
    c, scale = (BASE - 1) / BASE, 1.0 / np.log(BASE)
    up, down = 1 - c * (u - v * j), 1 - c * (v - u * j)
    p_up, p_down = -np.log(up) * scale, -np.log(down) * scale
    d_up, d_down = -c * v / up * scale, -c * u / down * scale
    same = 1 - p_up - p_down
    slope = greater * d_up / p_up + (m - equal - greater) * d_down / p_down - equal * (d_up + d_down) / same
    return (slope >= 0) & (np.minimum(size_a, size_b) >= similarity * np.maximum(size_a, size_b) * (1 - 1e-9))


def _settle(ids, sizes, sketch, sets, labels, side, percent: int) -> tuple[list[tuple[int, int]], int]:
    """What confirmed links join, as (least label, label) of the known components ``labels``, and the most central member.

    With ``side`` only pairs of different sides are looked at. Stars instead of the links themselves keep the graph shallow.
    """
    count = len(ids)
    parent = {x: x for x in labels}

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    central = np.zeros(count)
    found = []
    for i in range(count):
        others = np.arange(i + 1, count) if side is None else i + 1 + np.flatnonzero(side[i + 1 :] != side[i])
        if not len(others):
            continue
        equal = (sketch[others] == sketch[i]).sum(axis=1)
        central[i] += equal.sum()
        central[others] += equal
        near = equal >= REGISTERS * (percent / 100 - 0.25)
        others, equal = others[near], equal[near]
        if len(others):
            greater = (sketch[others] < sketch[i]).sum(axis=1)
            good = may_reach(equal, greater, sizes[i], sizes[others], percent / 100)
            found += [(-e, i, k) for e, k in zip(equal[good].tolist(), others[good].tolist()) if labels[i] != labels[k]]
    for _, i, k in sorted(found):
        a, b = top(labels[i]), top(labels[k])
        if a == b:
            continue
        common = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
        if 100 * common >= percent * (len(sets[i]) + len(sets[k]) - common):
            parent[max(a, b)] = min(a, b)
    return [(top(x), x) for x in sorted(parent) if top(x) != x], int(ids[int(central.argmax())])


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Settles each (cluster, block): rows (cluster, a, b) of links, and one row (cluster, centre, null)."""

    def run(key, table):
        let_go()
        ids = table.column("doc_id").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(ids), -1)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
        sizes = np.array([len(x) for x in sets], float)
        side = table.column("side").to_numpy()
        links, centre = _settle(ids, sizes, sketch, sets, table.column("label").to_pylist(), side if side.min() < side.max() else None, percent)
        rows = [*links, (centre, None)]
        return pa.table({"cluster": pa.array([key[0].as_py()] * len(rows), pa.int64()), "a": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.int64())})

    return members.select("cluster", "block", "doc_id", "label", "side", "sketch", "elements").groupBy("cluster", "block").applyInArrow(run, "cluster long, a long, b long")


def tiles(members: DataFrame, block: int) -> DataFrame:
    """Copies of the members for each pair of blocks of their cluster that has to be settled, ``block`` naming the pair.

    Classes outside the component ``main`` lie in the first ``outer`` blocks of a cluster, the others in the blocks after
    them. A pair is needed if its first block is an outer one; ``side`` tells which of the two a member comes from.
    """
    outside = F.col("label") != F.col("main")
    half = lambda rows: F.ceil(F.count(F.when(rows, 1)) * 2 / block).cast("int")
    counts = members.groupBy("cluster").agg(half(outside).alias("outer"), half(~outside).alias("inner"))
    own = F.pmod(F.xxhash64("doc_id"), F.when(outside, F.col("outer")).otherwise(F.col("inner"))).cast("int")
    total = F.col("outer") + F.col("inner")
    pair = lambda first, second, side: F.struct((first.cast("long") * total + second).alias("block"), F.lit(side).alias("side"))
    none = F.array().cast("array<int>")
    ahead = F.when(outside, F.sequence("own", total - 1)).otherwise(none)
    behind = F.least("own", "outer")
    behind = F.when(behind > 0, F.sequence(F.lit(0), behind - 1)).otherwise(none)
    return (
        members.join(lookup(counts), "cluster").withColumn("own", F.when(outside, own).otherwise(own + F.col("outer")))
        .withColumn("pair", F.explode(F.concat(F.transform(ahead, lambda x: pair(F.col("own"), x, 0)), F.transform(behind, lambda x: pair(x, F.col("own"), 1)))))
        .select("cluster", F.col("pair.block").alias("block"), "doc_id", "label", F.col("pair.side").alias("side"), "sketch", "elements")
    )


def _elements(docs: DataFrame, members: DataFrame, n: int, lower: bool) -> DataFrame:
    """Full sets of the members, from their texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower)
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for low, high in slices(offsets, TEXT_BYTES):
                words, before = hasher.words(data, offsets[low : high + 1])
                elements, at = shingle_sets(words, before, n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low).cast(pa.int64()), pa.array([elements[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], names=["doc_id", "elements"])

    return only(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), members).mapInArrow(frugal(make), "doc_id long, elements binary")


def links(docs: DataFrame, classes: DataFrame, n: int, percent: int, lower: bool, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose connected components are those of all confirmed links between classes."""
    groups = contracted_labels(stored(candidate_links(classes))).select(F.col("node").alias("doc_id"), F.col("label").alias("cluster"))
    sizes = lookup(groups.groupBy("cluster").agg(F.count("*").alias("size")))
    # 1 block for a group that fits, else blocks of half the size on average: a hash deals them unevenly.
    members = (
        groups.join(sizes, "cluster").withColumn("blocks", F.when(F.col("size") <= block, 1).otherwise(F.ceil(F.col("size") * 2 / block)).cast("int"))
        .join(only(classes.select("doc_id", "sketch"), groups), "doc_id").join(_elements(docs, groups, n, lower), "doc_id")
        .select("cluster", "doc_id", "blocks", "sketch", "elements")
    )
    members = stored(members.withColumn("label", F.col("doc_id")).withColumn("side", F.lit(0)))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))

    settled = stored(_blocks(dealt(members), percent))
    found = settled.where("b is not null").select("a", "b")
    large = members.where("blocks > 1")
    if not large.limit(1).count():
        return found
    centres = settled.where("b is null").select("cluster", F.col("a").alias("doc_id"))
    while True:  # centres of the blocks, until a group's centres fit one block
        counted = centres.groupBy("cluster").agg(F.count("*").alias("size")).where("size > 1")
        level = large.drop("blocks").join(centres, ["cluster", "doc_id"], "left_semi").join(counted, "cluster").withColumn("blocks", F.when(F.col("size") <= block, 1).otherwise(F.ceil(F.col("size") * 2 / block)).cast("int"))
        more = stored(_blocks(dealt(level), percent))
        found = found.union(more.where("b is not null").select("a", "b"))
        centres = more.where("b is null").select("cluster", F.col("a").alias("doc_id"))
        if not centres.groupBy("cluster").count().where("count > 1").limit(1).count():
            break
    labels = least_labels(found).select(F.col("node").alias("doc_id"), F.col("label").alias("component"))
    labelled = large.join(labels, "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")
    main = labelled.groupBy("cluster", "label").agg(F.count("*").alias("size")).groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    return found.union(stored(_blocks(tiles(labelled.join(main, "cluster"), block), percent)).where("b is not null").select("a", "b"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, lower: bool = True, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable), kept.

    Documents are linked when 100 * intersection >= percent * union of their sets of n-word shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(features(docs, n, lower))
    classes = rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    classes = stored(classes)
    members = rows.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"))
    copies = stored(members.where("class_id <> doc_id").select("doc_id"))
    heads = only(rows.where("set_key is not null").select("doc_id", "sketch"), copies, "left_anti")
    found = links(docs, heads, n, percent, lower, block)
    labels = least_labels(found).select(F.col("node").alias("class_id"), "label")
    return members.join(labels, "class_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "class_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
