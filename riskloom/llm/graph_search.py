"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard, searched by beam.

Points enter a shard's graph in batches. A greedy beam search from the shard's centre proposes the
neighbours of each; pruning keeps a proposal only if no kept neighbour is closer to it by the factor
``SLACK``, so that the edges left point different ways; edges back are added and pruned alike. The
search for a query runs on every shard, and the best of all shards are ranked by the exact cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.base import stored

EDGES, BUILD_BEAM, SEARCH_BEAM, SLACK = 24, 48, 128, 1.2
#: Different vectors per shard, and queries per task; both bound a task's memory.
SHARD, BLOCK = 4096, 8192
BATCH, EXPAND = 256, 4


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``beam`` nearest points found, nearest first: ids (-1: none) and squared distances. Points are unit vectors."""
    n = len(queries)
    ids = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    ids[:, 0] = entry
    far[:, 0] = 2 - 2 * (queries @ points[entry])
    seen = np.zeros((n, beam), bool)
    while True:
        open_ = np.where(seen | (ids < 0), np.inf, far)
        pick = np.argpartition(open_, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND] if beam > EXPAND else np.argsort(open_, axis=1)
        ready = np.isfinite(np.take_along_axis(open_, pick, 1))
        live = np.flatnonzero(ready.any(axis=1))
        if not len(live):
            return ids, far
        pick, ready = pick[live], ready[live]
        seen[live[:, None], pick] |= ready
        beside = np.where(ready[:, :, None], graph[np.where(ready, ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
        beside.sort(axis=1)
        beside[:, 1:][beside[:, 1:] == beside[:, :-1]] = -1
        known = (beside[:, :, None] == ids[live][:, None, :]).any(axis=2)
        beside[known] = -1
        away = 2 - 2 * np.einsum("brd,bd->br", points[np.maximum(beside, 0)], queries[live])
        away[beside < 0] = np.inf
        all_ids = np.concatenate((ids[live], beside), axis=1)
        all_far = np.concatenate((far[live], away.astype(np.float32)), axis=1)
        all_seen = np.concatenate((seen[live], np.zeros(beside.shape, bool)), axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[live], far[live], seen[live] = (np.take_along_axis(x, order, 1) for x in (all_ids, all_far, all_seen))


def prune(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """Up to `EDGES` diverse neighbours of each node out of its proposals (-1: none), nearest first."""
    proposed = np.where(proposed == nodes[:, None], -1, proposed)
    vectors = points[np.maximum(proposed, 0)]
    far = 2 - 2 * np.einsum("bcd,bd->bc", vectors, points[nodes])
    far[proposed < 0] = np.inf
    alive = far.copy()
    out = np.full((len(nodes), EDGES), -1, np.int64)
    row = np.arange(len(nodes))
    for k in range(EDGES):
        best = np.argmin(alive, axis=1)
        ok = np.isfinite(alive[row, best])
        if not ok.any():
            break
        out[ok, k] = proposed[row, best][ok]
        between = 2 - 2 * np.einsum("bcd,bd->bc", vectors, vectors[row, best])
        alive[(SLACK * between <= far) & ok[:, None]] = np.inf
        alive[row, best] = np.inf
    return out


def build(points: np.ndarray) -> tuple[np.ndarray, int]:
    """The graph (`EDGES` neighbours per point, -1: none) over unit vectors, and the entry: the point nearest to the mean."""
    n = len(points)
    graph = np.full((n, EDGES), -1, np.int64)
    entry = int(np.argmax(points @ points.mean(axis=0)))
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at = 1
    while at < n:
        new = order[at:at + min(BATCH, at)]
        found, _ = beam_search(points, graph, entry, points[new], BUILD_BEAM)
        # Points of one batch do not see each other in the graph yet; the nearest of them are proposed as well.
        close = points[new] @ points[new].T
        np.fill_diagonal(close, -np.inf)
        mates = new[np.argsort(-close, axis=1)[:, :8]] if len(new) > 1 else np.empty((1, 0), np.int64)
        graph[new] = prune(points, new, np.concatenate((found, mates), axis=1))
        _link_back(points, graph, new)
        at += len(new)
    return graph, entry


def _link_back(points: np.ndarray, graph: np.ndarray, new: np.ndarray) -> None:
    source = np.repeat(new, EDGES)
    target = graph[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    if not len(nodes):
        return
    offered = np.full((len(nodes), int(count.max())), -1, np.int64)
    offered[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = source
    offered[(offered[:, :, None] == graph[nodes][:, None, :]).any(axis=2)] = -1
    held = (graph[nodes] >= 0).sum(axis=1)
    more = (offered >= 0).sum(axis=1)
    for full in (False, True):
        which = np.flatnonzero(((held + more > EDGES) == full) & (more > 0))
        for at in range(0, len(which), BATCH):
            w = which[at:at + BATCH]
            both = np.concatenate((graph[nodes[w]], offered[w]), axis=1)
            if full:
                graph[nodes[w]] = prune(points, nodes[w], both)
            else:
                rank = np.argsort(both < 0, axis=1, kind="stable")[:, :EDGES]
                graph[nodes[w]] = np.take_along_axis(both, rank, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of doubles."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def _stack(column: pd.Series, dtype=np.float64) -> np.ndarray:
    return np.stack([np.asarray(v, dtype) for v in column])


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` as doubles: rows with id and a vector that is not empty, not zero, and finite throughout; equal rows once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and embedding is not null")
    return rows.where((F.size("embedding") > 0) & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
                      & F.exists("embedding", lambda v: v != 0)).distinct()


def index(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Graphs over all `usable` vectors: ``dim, shard, node, entry, ids, embedding, beside`` and the number of shards.

    Equal vectors are one node that carries its ``k + 1`` smallest ids (as many as any answer can need);
    the limit applies before the shuffle, so thousands of equal vectors stay few rows. Vectors of
    different length are apart. Shards are dealt by hash and hold about `SHARD` nodes.
    """
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = vectors.withColumn("place", place).where(F.col("place") <= k + 1)
    nodes = stored(few.groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "graph-nodes")
    shards = max(1, math.ceil(nodes.count() / SHARD))
    dealt = nodes.select(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"), "ids", "embedding")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(first=[v[0] for v in pdf["ids"]]).sort_values("first").drop(columns="first").reset_index(drop=True)
        graph, entry = build(_unit(_stack(pdf["embedding"])))
        return pdf.assign(node=np.arange(len(pdf), dtype=np.int32), entry=np.int32(entry), beside=list(graph.astype(np.int32)))[
            ["dim", "shard", "node", "entry", "ids", "embedding", "beside"]]

    schema = "dim int, shard int, node int, entry int, ids array<long>, embedding array<double>, beside array<int>"
    return stored(dealt.groupBy("dim", "shard").applyInPandas(run, schema), "graph-index"), shards


def search(graphs: DataFrame, shards: int, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query ``(vec_id, embedding)``, its own id left out.

    Queries are cut into blocks; a task takes one block and one shard. Each shard offers its ``k + 1``
    best nodes by exact cosine, in doubles on the original vectors.
    """
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    asked = queries.select(F.size("embedding").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.col("vec_id").alias("query_id"), "embedding")
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(nodes: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(nodes) or not len(wanted):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        nodes = nodes.sort_values("node")
        raw, graph, ids = _stack(nodes["embedding"]), _stack(nodes["beside"], np.int64), nodes["ids"].tolist()
        points, entry, out = _unit(raw), int(nodes["entry"].iloc[0]), []
        for at in range(0, len(wanted), BATCH):
            some = wanted.iloc[at:at + BATCH]
            asked_for = _stack(some["embedding"])
            found, _ = beam_search(points, graph, entry, _unit(asked_for), SEARCH_BEAM)
            score = cosines(raw[np.maximum(found, 0)], asked_for[:, None, :])
            score[found < 0] = -np.inf
            first = np.array([[ids[c][0] for c in row] for row in found.tolist()])
            best = np.lexsort((first, -score), axis=1)[:, :k + 1]
            for q, row in enumerate(best):
                own = int(some["query_id"].iloc[q])
                out += [(own, int(v), score[q, c]) for c in row if found[q, c] >= 0 for v in ids[found[q, c]] if v != own]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["dim", "shard", "block"]
    offers = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return offers.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest of every row whose vec_id is divisible by ``every``, among all rows but its own.

    Null, zero, empty and non-finite vectors and rows without id take no part; an id with two vectors
    asks with both and may be found by either. Fewer candidates than ``k`` are all returned; an empty
    table has no answers.
    """
    rows = usable(vectors)
    graphs, shards = index(rows, k)
    return search(graphs, shards, rows.where(F.col("vec_id") % every == 0), k)
