"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Vectors are dealt to shards of about `SHARD_ROWS` rows by a hash of their id.
Inside a shard equal vectors are one node.  Starting from random edges, every
node is searched for greedily in the graph so far; the nodes visited are its
candidates, and relaxed pruning keeps an edge to the nearest, drops all
candidates that an edge kept so far is `ALPHA` times nearer to, and goes on, so
edges stay diverse.  Kept edges are entered backwards too and pruned where they
exceed `DEGREE`.  Two passes, the first with alpha 1.  Searches of many nodes
advance together as array operations.

The graphs are a table (shard, node, vector, ids, edges).  A query runs a beam
search of width `BEAM` in every shard; the shards' nearest are merged per query.
Distances are Euclidean in double precision on the original vectors.

Defined results: vectors that are null, empty, all zero, or hold null or
non-finite components take no part, neither as query nor as candidate; vectors of
another length than the query are not compared with it; ties go to the smaller
id; fewer candidates than asked for give all found; equal vectors are all
answers (a node keeps the K + 1 smallest of its ids, which is all that a
query can return); repeated rows of an id count once; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kinfold.session import materialize

SHARD_ROWS = 2000
DEGREE = 40
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
K = 10
QUERY_EVERY = 100
_TOGETHER = 512  # searches that advance together
_QUERY_BLOCK = 2000  # queries that a task of one shard answers at once


def searchable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(~bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _gaps(vectors: np.ndarray, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of query i to the nodes at[i]; infinite where a slot is empty (-1)."""
    difference = vectors[np.maximum(at, 0)] - queries[:, None, :]
    return np.where(at < 0, np.inf, np.einsum("qnd,qnd->qn", difference, difference))


def beam_search(vectors: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, width: int):
    """Per query the `width` nearest nodes met (-1 padded), their squared distances, and all nodes expanded."""
    n = len(queries)
    beam = np.full((n, width), -1, np.int64)
    beam[:, 0] = entry
    gap = np.full((n, width), np.inf)
    gap[:, 0] = _gaps(vectors, queries, beam[:, :1])[:, 0]
    expanded = np.zeros((n, width), bool)
    visited = []
    live = np.arange(n)
    while len(live):
        open_gap = np.where(expanded[live] | (beam[live] < 0), np.inf, gap[live])
        pick = open_gap.argmin(axis=1)
        more = np.isfinite(open_gap[np.arange(len(live)), pick])
        live, pick = live[more], pick[more]
        if not len(live):
            break
        node = beam[live, pick]
        expanded[live, pick] = True
        visited.append((live, node))
        new = edges[node]
        known = (new[:, :, None] == beam[live][:, None, :]).any(axis=2)
        new = np.where(known, -1, new)
        all_nodes = np.concatenate([beam[live], new], axis=1)
        all_gaps = np.concatenate([gap[live], _gaps(vectors, queries[live], new)], axis=1)
        done = np.concatenate([expanded[live], np.zeros(new.shape, bool)], axis=1)
        best = np.argpartition(all_gaps, width - 1, axis=1)[:, :width]
        rows = np.arange(len(live))[:, None]
        beam[live], gap[live], expanded[live] = all_nodes[rows, best], all_gaps[rows, best], done[rows, best]
    return beam, gap, visited


def pruned(vectors: np.ndarray, node: int, candidates: np.ndarray, alpha: float) -> np.ndarray:
    """Relaxed pruning of a node's candidates to at most DEGREE diverse edges."""
    candidates = np.unique(candidates)
    candidates = candidates[(candidates >= 0) & (candidates != node)]
    points = vectors[candidates]
    to_node = np.linalg.norm(points - vectors[node], axis=1)
    order = np.argsort(to_node, kind="stable")
    candidates, points, to_node = candidates[order], points[order], to_node[order]
    squares = np.einsum("nd,nd->n", points, points)
    between = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * points @ points.T, 0))
    alive, kept = np.ones(len(candidates), bool), []
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == DEGREE:
                break
            alive &= alpha * between[i] > to_node
    return candidates[kept]


def build_graph(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """(edges, -1 padded; entry node: the one nearest to the mean)."""
    n = len(vectors)
    rng = np.random.default_rng(n)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, DEGREE), -1, np.int64)
    if n > 1:
        start = min(DEGREE // 2, n - 1)
        edges[:, :start] = (np.arange(n)[:, None] + rng.integers(1, n, (n, start))) % n
    for alpha in (1.0, ALPHA):
        order = rng.permutation(n)
        for at in range(0, n, _TOGETHER):
            some = order[at:at + _TOGETHER]
            _, _, visited = beam_search(vectors, edges, entry, vectors[some], BUILD_BEAM)
            rows = np.concatenate([v[0] for v in visited])
            nodes = np.concatenate([v[1] for v in visited])
            by_row = np.argsort(rows, kind="stable")
            bounds = np.searchsorted(rows[by_row], np.arange(len(some) + 1))
            nodes = nodes[by_row]
            back: dict[int, list[int]] = {}
            for k, node in enumerate(some.tolist()):
                kept = pruned(vectors, node, np.concatenate([nodes[bounds[k]:bounds[k + 1]], edges[node]]), alpha)
                edges[node] = -1
                edges[node, :len(kept)] = kept
                for other in kept.tolist():
                    back.setdefault(other, []).append(node)
            for node, others in back.items():
                there = edges[node][edges[node] >= 0]
                both = np.union1d(there, others)
                if len(both) > DEGREE:
                    both = pruned(vectors, node, both, alpha)
                edges[node] = -1
                edges[node, :len(both)] = both
    return edges, entry


def _shard_graph(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    raw = np.array(table.column("vector").to_pylist(), np.float64)
    order = np.argsort(ids, kind="stable")
    ids, raw = ids[order], raw[order]
    _, first = np.unique(ids, return_index=True)
    ids, raw = ids[first], raw[first]
    nodes, of_node = np.unique(raw, axis=0, return_inverse=True)
    of_node = of_node.ravel()
    by_node = np.argsort(of_node, kind="stable")  # ids ascend within a node
    bounds = np.searchsorted(of_node[by_node], np.arange(len(nodes) + 1))
    edges, entry = build_graph(nodes)
    return pa.table({
        "dim": pa.array([nodes.shape[1]] * len(nodes), pa.int32()),
        "shard": pa.array([table.column("shard")[0].as_py()] * len(nodes), pa.int32()), "node": pa.array(np.arange(len(nodes)), pa.int32()),
        "entry": pa.array(np.arange(len(nodes)) == entry), "vector": pa.array(list(nodes), pa.list_(pa.float64())),
        "ids": pa.array([ids[by_node[a:a + min(b - a, K + 1)]] for a, b in zip(bounds[:-1], bounds[1:])], pa.list_(pa.int64())),
        "edges": pa.array([e[e >= 0] for e in edges], pa.list_(pa.int32()))})


_GRAPH = "dim int, shard int, node int, entry boolean, vector array<double>, ids array<long>, edges array<int>"


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The graphs of all shards as a table in the shared folder."""
    usable = (vectors.filter(F.col(vec_id).isNotNull() & searchable(F.col(vector)))
              .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
              .withColumn("dim", F.size("vector")))
    shards = max(1, math.ceil(usable.count() / SHARD_ROWS))
    dealt = usable.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    # Work per shard, not bytes, is what counts here, so small shards must not be merged into one task.
    spread = dealt.repartition(2 * shards, "dim", "shard")
    return materialize(spread.groupBy("dim", "shard").applyInArrow(_shard_graph, _GRAPH), "vamana")


def _searcher(k: int):
    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not graph.num_rows or not queries.num_rows:
            return schema.empty_table()
        graph = graph.sort_by("node")
        vectors = np.array(graph.column("vector").to_pylist(), np.float64)
        ids = graph.column("ids").to_pylist()
        lists = graph.column("edges").to_pylist()
        edges = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int64)
        for node, list_ in enumerate(lists):
            edges[node, :len(list_)] = list_
        entry = graph.column("entry").to_pylist().index(True)
        asked = queries.column("query_id").to_numpy()
        wanted = np.array(queries.column("vector").to_pylist(), np.float64)
        out = []
        for at in range(0, len(asked), _TOGETHER):
            some = wanted[at:at + _TOGETHER]
            beam, _, _ = beam_search(vectors, edges, entry, some, BEAM)
            for query_id, query, nodes in zip(asked[at:at + _TOGETHER].tolist(), some, beam):
                nodes = nodes[nodes >= 0]
                scores = np.sqrt(((vectors[nodes] - query) ** 2).sum(axis=1))
                near = sorted((s, i) for s, n in zip(scores.tolist(), nodes.tolist()) for i in ids[n] if i != query_id)
                out += [(query_id, i, s) for s, i in near[:k]]
        columns = list(zip(*out)) or [[], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
    return run


def search(graphs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest over all shards, itself left out.

    `queries` has (query_id, vector).  Every query visits every shard once; queries
    go in blocks, so a task holds one shard's graph and one block.
    """
    if k > K:
        raise ValueError(f"k must be at most {K}, the number of equal vectors that nodes list")
    asked = queries.withColumn("q_dim", F.size("vector"))
    blocks = max(1, math.ceil(asked.count() / _QUERY_BLOCK))
    numbered = asked.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    shards = graphs.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard")).distinct()
    tasks = 2 * blocks * max(1, shards.count())
    sent = numbered.join(shards, "q_dim").repartition(tasks, "q_dim", "q_shard", "q_block")
    held = (graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .repartition(tasks, "dim", "shard", "block"))
    near = held.groupBy("dim", "shard", "block").cogroup(sent.groupBy("q_dim", "q_shard", "q_block")).applyInArrow(_searcher(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def report(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100, among all vectors."""
    queries = (vectors.filter((F.col(vec_id) % QUERY_EVERY == 0) & searchable(F.col(vector)))
               .select(F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector"))
               .dropDuplicates(["query_id"]))
    return search(build(vectors, vec_id, vector), queries)
