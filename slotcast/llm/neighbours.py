"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Building. Equal vectors are one node. Nodes are dealt to the leaves of ``TREES`` random-hyperplane trees of about ``leaf``
nodes (planes are placed at the medians of a sample of ``SAMPLE`` vectors), inside which the first neighbour lists are
found. Then neighbours of neighbours: every node's list is joined with the lists it stands in (the nearest ``LINKS`` of
them) and with the vectors of both; all pairs inside such a neighbourhood are scored, and those better than the
worst of a member's list are merged into it. Each round is a set of Spark joins over the whole graph.

Searching. A query's pool starts with its own list. Each round the ``step`` nearest unexpanded members of the pool are
joined with the graph, nodes not met before are scored, and the nearest ``pool`` of all are kept, until nothing is left
to expand or ``ROUNDS`` are over. Queries are handled in blocks whose vectors are broadcast. Results are scored once
more on the original vectors in double precision; ties go to the smaller id.

Only lists of ids, scores and, within a neighbourhood of at most 2 * ``LINKS`` nodes, vectors are gathered. Vectors that
are null, zero, of another length than most, or hold null or non-finite components take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

TREES, LEAF, SAMPLE = 10, 800, 4096
LINKS, DESCENTS = 24, 2
POOL, STEP, ROUNDS = 256, 96, 6
BLOCK = 16_384
SEED = 5
LIST = "array<struct<s: float, id: long>>"


def vectors(table: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows (id, vec) of the vectors that take part; vec holds the components as 64-bit floats."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not v or None in v:
                    continue
                x = np.array(v, np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())], names=["id", "vec"])

    found = stored(table.select(F.col(key).cast("long"), column).mapInArrow(make, "id long, vec binary"))
    common = found.groupBy(F.length("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return found.where(F.length("vec") == (common[0]["size"] if common else 0))


def _units(column: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, exactly, so that their squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _short(x: np.ndarray) -> pa.Array:
    """Unit vectors in single precision: what ranks candidates, near copies among them."""
    return pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())


def _lists(owner: np.ndarray, other: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(other, pa.int64()), pa.array(score.astype(np.float32))], names=["id", "other", "s"])


def nearest_lists(pairs: DataFrame, links: int) -> DataFrame:
    """The ``links`` best others of each id: rows (id, list) with the best first. ``pairs``: (id, other, s)."""
    order = Window.partitionBy("id").orderBy(F.desc("s"), "other")
    best = pairs.groupBy("id", "other").agg(F.max("s").alias("s")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= links)
    return best.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("d"), F.col("other").alias("id")))), lambda x: F.struct((-x["d"]).alias("s"), x["id"].alias("id"))).alias("list"))


def leaf_pairs(nodes: DataFrame, count: int, links: int, trees: int, leaf: int) -> DataFrame:
    """Near pairs (id, other, s) inside the leaves of the trees. ``nodes``: (id, short)."""
    sample = nodes.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE).select("short").collect()
    points = np.array([np.frombuffer(r["short"], np.float32) for r in sample], np.float32)
    if not len(points):
        return nodes.select("id", F.col("id").alias("other"), F.lit(0.0).cast("float").alias("s"))  # no rows
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / leaf))))
    planes = np.random.default_rng(SEED).normal(size=(points.shape[1], trees * bits)).astype(np.float32)
    middles = np.median(points @ planes, axis=0) if bits else np.zeros(0)
    per_tree = links // 2 + 4

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = np.array([np.frombuffer(v, np.float32) for v in batch.column(1).to_pylist()], np.float32)
            code = ((x @ planes > middles).reshape(len(x), trees, bits) * weights).sum(axis=2) if bits else np.zeros((len(x), trees), np.int64)
            at = np.repeat(np.arange(len(x)), trees)
            short = batch.column(1).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), short, pa.array(np.tile(np.arange(trees), len(x))), pa.array(code.reshape(-1))], names=["id", "short", "tree", "leaf"])

    dealt = nodes.select("id", "short").mapInArrow(deal, "id long, short binary, tree long, leaf long")
    large = dealt.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > 2 * leaf)
    # A leaf of a dense region is split by a hash; descent joins what this parts.
    salted = dealt.join(large, ["tree", "leaf"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / leaf)), F.lit(0)))

    def score(key, table):
        ids = table.column("id").to_numpy()
        x = np.array([np.frombuffer(v, np.float32) for v in table.column("short").to_pylist()], np.float32)
        keep = min(per_tree, len(ids) - 1)
        if keep < 1:
            return pa.Table.from_batches([_lists(ids[:0], ids[:0], np.zeros(0))])
        s = x @ x.T
        np.fill_diagonal(s, -4)
        near = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
        return pa.Table.from_batches([_lists(np.repeat(ids, keep), ids[near.reshape(-1)], np.take_along_axis(s, near, 1).reshape(-1))])

    return salted.select("tree", "leaf", "salt", "id", "short").groupBy("tree", "leaf", "salt").applyInArrow(score, "id long, other long, s float")


def neighbourhoods(graph: DataFrame, links: int) -> DataFrame:
    """Rows (id, other, s): a node's list and the nearest ``links`` lists it stands in."""
    ahead = graph.select("id", F.explode("list").alias("x")).select("id", F.col("x.id").alias("other"), F.col("x.s").alias("s"))
    order = Window.partitionBy("other").orderBy(F.desc("s"), "id")
    back = ahead.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= links).select(F.col("other").alias("id"), F.col("id").alias("other"), "s")
    return ahead.union(back).distinct()


def descend(graph: DataFrame, nodes: DataFrame, links: int) -> DataFrame:
    """One round of neighbours of neighbours: the pairs (id, other, s) that improve a list."""
    worst = graph.select("id", F.when(F.size("list") < links, F.lit(-4.0)).otherwise(F.element_at("list", -1)["s"]).cast("float").alias("worst"))
    points = nodes.select("id", "short").join(worst, "id", "left").select(F.col("id").alias("other"), "short", F.coalesce("worst", F.lit(-4.0)).cast("float").alias("worst"))
    around = neighbourhoods(graph, links).select("id", "other").join(points, "other")
    gathered = around.groupBy("id").agg(F.collect_list(F.struct("other", "short", "worst")).alias("members"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for members in batch.column(0).to_pylist():
                ids = np.array([m["other"] for m in members], np.int64)
                x = np.array([np.frombuffer(m["short"], np.float32) for m in members], np.float32)
                s = x @ x.T
                np.fill_diagonal(s, -4)
                a, b = np.nonzero(s > np.array([m["worst"] for m in members], np.float32)[:, None])
                parts.append((ids[a], ids[b], s[a, b]))
            if parts:
                yield _lists(*(np.concatenate([p[k] for p in parts]) for k in range(3)))

    return gathered.select("members").mapInArrow(make, "id long, other long, s float")


def build(nodes: DataFrame, links: int = LINKS, trees: int = TREES, leaf: int = LEAF, rounds: int = DESCENTS) -> DataFrame:
    """The neighbour graph (id, list) of nodes (id, short)."""
    count = nodes.count()
    graph = stored(nearest_lists(leaf_pairs(nodes, count, links, trees, leaf), links))
    for _ in range(rounds):
        known = graph.select("id", F.explode("list").alias("x")).select("id", F.col("x.id").alias("other"), F.col("x.s").alias("s"))
        graph = stored(nearest_lists(known.union(descend(graph, nodes, links)), links))
    return graph


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, links: int = LINKS, pool: int = POOL, step: int = STEP, rounds: int = ROUNDS) -> DataFrame:
    """Rows (query, id): the pools of the queries, which are nodes (id, short) of the graph themselves."""
    spark = nodes.sparkSession
    around = stored(neighbourhoods(graph, links).groupBy("id").agg(F.collect_list("other").alias("others")))
    blocks = max(1, -(-queries.count() // BLOCK))
    found = None
    for block in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(blocks)) == block)
        rows = own.collect()  # one block of queries
        if not rows:
            continue
        place = {r["id"]: i for i, r in enumerate(rows)}
        points = np.array([np.frombuffer(r["short"], np.float32) for r in rows], np.float32)
        shared = spark.sparkContext.broadcast((place, points))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            where, x = shared.value
            for batch in batches:
                if len(batch):
                    q = x[[where[i] for i in batch.column(0).to_pylist()]]
                    y = np.array([np.frombuffer(v, np.float32) for v in batch.column(2).to_pylist()], np.float32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.einsum("ij,ij->i", q, y))], names=["query", "id", "s"])

        # met: all nodes scored so far; front: those to expand next.
        state = stored(own.select(F.col("id").alias("query"), F.array().cast(LIST).alias("pool"), F.array("id").alias("met"), F.array("id").alias("front"), F.array().cast("array<long>").alias("done")))
        for _ in range(rounds):
            reached = (
                state.select("query", F.explode("front").alias("id")).join(around, "id")
                .select("query", F.explode("others").alias("id")).distinct().groupBy("query").agg(F.collect_list("id").alias("reached"))
            )
            fresh = stored(state.join(reached, "query", "left").withColumn("fresh", F.array_except(F.coalesce("reached", F.array().cast("array<long>")), "met")).drop("reached"))
            scored = (
                fresh.select("query", F.explode("fresh").alias("id")).join(nodes.select("id", "short"), "id").select("query", "id", "short")
                .mapInArrow(score, "query long, id long, s float")
                .groupBy("query").agg(F.collect_list(F.struct((-F.col("s")).alias("d"), "id")).alias("more"))
            )
            merged = fresh.join(scored, "query", "left").select(
                "query", "met", "fresh", "done", "front",
                F.slice(F.array_sort(F.concat(F.transform("pool", lambda x: F.struct((-x["s"]).alias("d"), x["id"].alias("id"))), F.coalesce("more", F.array().cast("array<struct<d: float, id: long>>")))), 1, pool).alias("near"),
            )
            after = merged.select(
                "query", F.transform("near", lambda x: F.struct((-x["d"]).alias("s"), x["id"].alias("id"))).alias("pool"),
                F.concat("met", "fresh").alias("met"), F.array_union("done", "front").alias("done"),
            )
            state = stored(after.withColumn("front", F.slice(F.array_except(F.transform("pool", lambda x: x["id"]), "done"), 1, step)))
            if not state.where("size(front) > 0").limit(1).count():
                break
        part = state.select("query", F.explode("pool").alias("x")).select("query", F.col("x.id").alias("id"))
        found = part if found is None else found.union(part)
    return found if found is not None else queries.select(F.col("id").alias("query"), "id").limit(0)


def nearest(table: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", column: str = "embedding", **settings) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of each query's k nearest other vectors. ``queries``: (id), ids of vectors."""
    build_with = {n: v for n, v in settings.items() if n in ("links", "trees", "leaf", "rounds")}
    search_with = {n: v for n, v in settings.items() if n in ("links", "pool", "step")}
    all_rows = vectors(table, key, column)
    members = stored(all_rows.join(all_rows.groupBy("vec").agg(F.min("id").alias("node")), "vec").select("id", "node"))
    # Of equal vectors the k + 1 smallest ids are enough: one may be the query itself.
    nth = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    first = members.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("node").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), _short(_units(batch.column(1)))], names=["id", "short"])

    whole = all_rows.join(members.where("id = node").select("id"), "id", "left_semi")
    nodes = stored(whole.select("id", "vec").mapInArrow(short, "id long, short binary"))
    graph = build(nodes, **build_with)
    asked = stored(queries.select(F.col("id").cast("long").alias("id")).distinct().join(members, "id").select(F.col("id").alias("query_id"), "node"))
    heads = nodes.join(asked.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    pools = search(graph, nodes, heads, **search_with)
    itself = asked.select("node", F.col("node").alias("id")).distinct()
    pairs = stored(pools.select(F.col("query").alias("node"), "id").union(itself).distinct())

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b = (_scaled(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(len(batch), -1)) for c in (2, 3))
                s = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)], names=["node", "id", "score"])

    scored = (
        pairs.join(whole.select("id", F.col("vec").alias("other")), "id").join(whole.select(F.col("id").alias("node"), "vec"), "node")
        .select("node", "id", "vec", "other").mapInArrow(exact, "node long, id long, score double")
    )
    order = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    best = scored.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= 2 * k + 2).drop("nth")
    expanded = asked.join(best, "node").join(first.select(F.col("node").alias("id"), "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    by_rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return expanded.withColumn("rank", by_rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
