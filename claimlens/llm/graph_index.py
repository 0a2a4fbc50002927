"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph per shard, beam search over all.

Rows are dealt by a hash into shards of about ``SHARD``; one task builds a shard's graph and writes it as one row.
Identical vectors of a shard are one node that lists its ids, so that copies neither disconnect a graph nor fill a beam.

Inner product becomes a metric by one more entry, sqrt(M^2 - |x|^2) with the shard's largest norm M: all nodes then lie on
a sphere, where the nearest point has the largest inner product.  Nodes enter the graph in batches of doubling size: a
greedy beam search in the graph so far proposes neighbours, and relaxed pruning keeps, nearest first, those that no kept
one is ``ALPHA`` times nearer to than the node itself is.  Kept neighbours point back; a node with more than twice
``DEGREE`` edges is pruned again.

Queries are answered in blocks.  A block's vectors go to the shards, each runs all its beams at once, scores what they
hold on the original vectors (the exact sum of the products, rounded once) and returns its best ``k``.  Shards are
searched in batches, as many as Spark runs at once and then as many as before: each later batch only returns hits that
reach the ``k``-th best of the earlier ones.

Rows without an id or with a vector that is null, empty, zero, not finite or not of the table's (largest) dimension take
no part, neither as candidates nor as queries.  Rows equal in id and vector are one.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.vectors import best_of, dimension, usable
from claimlens.session import new_stage_path, stage

SHARD = 4096  # rows of a shard, about
DEGREE = 32  # edges of a node
BEAM = 96  # nodes a query's search keeps
BUILD_BEAM = 64  # nodes the search of an entering node keeps
ALPHA = 1.2  # relaxation of the pruning
STARTS = 8  # nodes a search begins at
EXPANDED = 4  # nodes of a beam expanded in one step
BATCH = 512  # nodes that enter a graph together at most, and beams run together
CANDIDATES = 96  # nearest proposals that pruning looks at
BLOCK = 4096  # queries answered together, about


def beam_search(points: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries at once: the ``beam`` nearest nodes met, nearest first (-1: none), and the nodes met.

    ``points`` and ``queries`` lie on a sphere, so the nearest has the largest inner product.
    """
    n, m = len(queries), len(points)
    met = np.zeros((n, m), bool)
    node, near = np.full((n, beam), -1), np.full((n, beam), -np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    rows, found = np.repeat(np.arange(n), len(starts)), np.tile(starts, n)
    while len(rows):
        met[rows, found] = True
        closeness = np.einsum("ij,ij->i", points[found], queries[rows])
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        width = int(place.max()) + 1
        new_node, new_near = np.full((n, width), -1), np.full((n, width), -np.inf, np.float32)
        new_node[rows, place], new_near[rows, place] = found, closeness
        node, near = np.hstack([node, new_node]), np.hstack([near, new_near])
        done = np.hstack([done, np.zeros((n, width), bool)])
        order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        node, near, done = (np.take_along_axis(x, order, axis=1) for x in (node, near, done))
        todo = ~done & (node >= 0)
        todo &= np.cumsum(todo, axis=1) <= EXPANDED
        done |= todo
        rows, slot = np.nonzero(todo)
        reached = edges[node[rows, slot]]
        rows = np.repeat(rows, reached.shape[1])
        found = reached.ravel()
        fresh = found >= 0
        rows, found = rows[fresh], found[fresh]
        fresh = ~met[rows, found]
        pairs = np.unique(rows[fresh] * m + found[fresh])
        rows, found = pairs // m, pairs % m
    return node, met


def robust_prune(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` of each node's proposals (-1: none), nearest first, none much nearer to a kept one than to the node."""
    mine, valid = points[nodes], proposed >= 0
    near = np.where(valid, np.einsum("ij,ikj->ik", mine, points[proposed]), -np.inf)
    valid &= proposed != nodes[:, None]
    order = np.argsort(np.where(valid, -near, np.inf), axis=1, kind="stable")[:, :CANDIDATES]
    proposed, near, valid = (np.take_along_axis(x, order, axis=1) for x in (proposed, near, valid))
    others = points[proposed]
    between = np.matmul(others, others.transpose(0, 2, 1))
    # squared distances on the unit sphere are 2 - 2 * inner product
    own = 2.0 - 2.0 * np.where(valid, near, 1.0)
    between = 2.0 - 2.0 * between
    kept, every = np.full((len(nodes), degree), -1), np.arange(len(nodes))
    for slot in range(degree):
        left = valid.any(axis=1)
        if not left.any():
            break
        first = valid.argmax(axis=1)
        kept[left, slot] = proposed[every, first][left]
        valid &= alpha * alpha * between[every, first] > own
        valid[every, first] = False
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, slot; -1: none) of the graph over points on the unit sphere, and the nodes where searches begin."""
    m = len(points)
    order = np.random.default_rng(seed).permutation(m)
    middle = int((points @ points.mean(axis=0)).argmax())
    starts = np.unique(np.append(order[: STARTS - 1], middle))
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    edges = np.full((m, 2 * degree), -1)
    edges[starts, : len(starts) - 1] = [starts[starts != s] for s in starts]
    at = len(starts)
    while at < m:
        nodes = order[at : at + min(BATCH, at)]
        at += len(nodes)
        held, met = beam_search(points, edges, starts, points[nodes], beam)
        # whatever the searches met, nearest first, so that far nodes stay among the proposals
        rows, found = np.nonzero(met)
        closeness = np.einsum("ij,ij->i", points[found], points[nodes][rows])
        chosen = best_of(rows, closeness, found, CANDIDATES)
        rows, found = rows[chosen], found[chosen]
        proposed = np.full((len(nodes), CANDIDATES), -1)
        proposed[rows, np.arange(len(rows)) - np.searchsorted(rows, rows)] = found
        edges[nodes, :degree] = robust_prune(points, nodes, proposed, degree, alpha)
        _point_back(points, edges, nodes, degree, alpha)
    return edges, starts


def _point_back(points: np.ndarray, edges: np.ndarray, nodes: np.ndarray, degree: int, alpha: float) -> None:
    """Add the edges back to ``nodes`` from their neighbours; lists that would overflow are pruned."""
    source, target = np.repeat(nodes, degree), edges[nodes, :degree].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    touched, first, n = np.unique(target, return_index=True, return_counts=True)
    new = np.full((len(touched), n.max(initial=0)), -1)
    new[np.repeat(np.arange(len(touched)), n), np.arange(len(target)) - np.repeat(first, n)] = source
    used = (edges[touched] >= 0).sum(axis=1)
    room = used + n <= edges.shape[1]
    for row in np.flatnonzero(room):
        edges[touched[row], used[row] : used[row] + n[row]] = new[row, : n[row]]
    for start in range(0, len(full := np.flatnonzero(~room)), BATCH):
        part = full[start : start + BATCH]
        both = np.hstack([edges[touched[part]], new[part]])
        edges[touched[part]] = -1
        edges[touched[part], :degree] = robust_prune(points, touched[part], both, degree, alpha)


def on_sphere(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors of one more dimension, whose inner products with any query keep the vectors' order."""
    scaled = vectors / np.sqrt(np.square(vectors / (top := np.abs(vectors).max())).sum(axis=1).max()) / top
    last = np.sqrt(np.maximum(0.0, 1.0 - np.square(scaled).sum(axis=1)))
    return np.column_stack([scaled, last]).astype(np.float32)


@dataclass(frozen=True)
class GraphIndex:
    """One row per shard: ``shard``, ``keys`` (per node, ascending), ``vecs`` and ``edges`` as bytes, ``starts``."""

    shards: DataFrame
    dim: int
    n_shards: int
    key_type: str


def build_index(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD) -> GraphIndex | None:
    """Graphs over every usable row; None where there is none."""
    rows = usable(embeddings, key, vector).where(F.exists("vec", lambda x: x != 0))
    kind, d = dict(rows.dtypes)["key"], dimension(rows)
    if not d:
        return None
    # repeated rows are counted away before rows are dealt out, so that they cannot fill a shard
    rows = stage(rows.where(F.size("vec") == d).distinct(), "graph-rows")
    n_shards = -(-rows.count() // shard_rows)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors, node = np.unique(np.vstack(pdf["vec"].to_numpy()), axis=0, return_inverse=True)
        order = np.lexsort((pdf["key"].to_numpy(), node))
        keys = np.split(pdf["key"].to_numpy()[order], np.flatnonzero(np.diff(node[order])) + 1)
        edges, starts = build_graph(on_sphere(vectors))
        made = {"shard": pdf["shard"].iloc[0], "keys": [k.tolist() for k in keys], "vecs": vectors.tobytes()}
        return pd.DataFrame([made | {"edges": edges.astype("<i4").tobytes(), "starts": starts.astype("int32")}])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key", "vec"), F.lit(n_shards)).cast("int")).repartition(n_shards, "shard")
    schema = f"shard int, keys array<array<{kind}>>, vecs binary, edges binary, starts array<int>"
    return GraphIndex(stage(dealt.groupBy("shard").applyInPandas(build, schema), "graph-index"), d, n_shards, kind)


def _exact(nodes: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of paired rows: exact sums of the products, rounded once."""
    return np.fromiter((math.fsum(row) for row in (nodes * queries).tolist()), float, len(nodes))


def _search_shards(shards: DataFrame, index: GraphIndex, names: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int, beam: int) -> DataFrame:
    """Best ``k`` hits per query in each shard, as rows (query number, key, score)."""
    d, width = index.dim, max(beam, 2 * k)
    length = np.abs(vectors).max(axis=1, keepdims=True)
    asked = np.column_stack([vectors / length, np.zeros(len(vectors))]).astype(np.float32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch.itertuples():
                nodes = np.frombuffer(shard.vecs, "<f8").reshape(-1, d)
                edges = np.frombuffer(shard.edges, "<i4").reshape(len(nodes), -1)
                points, starts = on_sphere(nodes), np.asarray(shard.starts)
                for start in range(0, len(asked), BATCH):
                    held, _ = beam_search(points, edges, starts, asked[start : start + BATCH], width)
                    # as many nodes as can hold k hits beside the query itself, and some for the search's rounding
                    held = held[:, : k + 1 + k // 2]
                    query, slot = np.nonzero(held >= 0)
                    node = held[query, slot]
                    query = query + start
                    score = _exact(nodes[node], vectors[query])
                    high = score >= floors[query]
                    query, node, score = query[high], node[high], score[high]
                    keys = [list(shard.keys[i][: k + 1]) for i in node]
                    n = [len(x) for x in keys]
                    query, score = np.repeat(query, n), np.repeat(score, n)
                    key = np.array([x for some in keys for x in some])
                    other = key != names[query] if len(key) else np.zeros(0, bool)
                    query, score, key = query[other], score[other], key[other]
                    best = best_of(query, score, key, k)
                    yield pd.DataFrame({"query": query[best], "key": key[best], "score": score[best]})

    return shards.mapInPandas(run, f"query long, key {index.key_type}, score double")


def _growing(n: int, first: int) -> Iterator[range]:
    at = 0
    while at < n:
        size = max(first, at)
        yield range(at, min(n, at + size))
        at += size


def search(index: GraphIndex, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest indexed rows of other ids found for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` name their id and vector ``key`` and ``vector``; the id has the index's type.
    """
    spark = queries.sparkSession
    schema = f"query_id {index.key_type}, rank int, vec_id {index.key_type}, score double"
    rows = usable(queries, key, vector).where(F.exists("vec", lambda x: x != 0) & (F.size("vec") == index.dim)).distinct()
    asked = stage(rows, "graph-queries")
    blocks = max(1, -(-asked.count() // block))
    path, asked_path = new_stage_path(spark, "graph-answers"), new_stage_path(spark, "graph-asked")
    dealt = F.pmod(F.xxhash64("key", "vec"), F.lit(blocks)).cast("int")
    asked.withColumn("block", dealt).write.partitionBy("block").parquet(asked_path)
    asked = spark.read.schema(f"key {index.key_type}, vec array<double>, block int").parquet(asked_path)
    first = max(1, spark.sparkContext.defaultParallelism)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    written = 0
    for number in range(blocks):
        local = asked.where(F.col("block") == number).select("key", "vec").toPandas()
        if local.empty:
            continue
        names, vectors = local["key"].to_numpy(), np.vstack(local["vec"].to_numpy())
        floors, best = np.full(len(names), -np.inf), None
        for part in _growing(index.n_shards, first):
            some = index.shards.where(F.col("shard").between(part.start, part.stop - 1)).repartitionByRange(len(part), "shard")
            hits = _search_shards(some, index, names, vectors, floors, k, beam)
            hits = hits if best is None else hits.unionByName(best)
            ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            last = part.stop == index.n_shards
            best = stage(ranked if last else ranked.drop("rank"), "graph-best")
            if not last:
                for row in best.groupBy("query").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") == k).collect():
                    floors[row["query"]] = row["s"]
        # the block's ids by their number: as many as the block has
        named = spark.createDataFrame(pd.DataFrame({"query": np.arange(len(names)), "query_id": names}), f"query long, query_id {index.key_type}")
        answers = best.join(F.broadcast(named), "query").select("query_id", "rank", F.col("key").alias("vec_id"), "score")
        answers.write.mode("append").parquet(path)
        written += 1
    return spark.read.schema(schema).parquet(path) if written else spark.createDataFrame([], schema)


def nearest(embeddings: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """Index every row of ``embeddings`` and search it for the rows ``asked`` marks."""
    index = build_index(embeddings, key, vector)
    if index is None:
        kind = dict(embeddings.dtypes)[key]
        return embeddings.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    return search(index, embeddings.where(asked), key, vector, k)
