"""Approximate nearest neighbours: one navigable small-world graph per shard.

A shard's graph has layers: every node lies in layer 0, one in M of them also in layer 1, and
so on. A layer is one flat array with a fixed number of neighbour slots for each node. Graphs
are built and searched in waves of many nodes at once, as array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import mix64, staged

#: Neighbour slots in upper layers; layer 0 has twice as many.
M = 16
#: Candidates that a search keeps while a node is linked, and while a query is answered.
EF_BUILD, EF_SEARCH = 64, 128
_WAVE = 512


@dataclass
class Graph:
    """Unit vectors, and for each layer the flat neighbour array (-1: no neighbour)."""

    vectors: np.ndarray
    levels: np.ndarray
    layers: list[np.ndarray]
    entry: int


def _levels(n: int) -> np.ndarray:
    """The top layer of each node: a fixed scramble of its number, geometric in M."""
    u = (mix64(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2.0**53
    return np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(M)).astype(int), 6)


def _likeness(vectors: np.ndarray, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosines of each query with its own row of nodes."""
    return np.matmul(vectors[at], queries[:, :, None])[:, :, 0]


def _search_layer(
    g: Graph, layer: int, queries: np.ndarray, start: np.ndarray, ef: int
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``ef`` nodes that each query reaches, best first; -1 fills up."""
    links, n, b = g.layers[layer], len(g.vectors), len(queries)
    seen = np.zeros((b, n + 1), dtype=bool)
    rows = np.arange(b)
    width = max(ef, start.shape[1])
    at = np.full((b, width), -1, dtype=np.int64)
    like = np.full((b, width), -np.inf, dtype=np.float32)
    at[:, : start.shape[1]] = start
    like[:, : start.shape[1]] = np.where(start >= 0, _likeness(g.vectors, start, queries), -np.inf)
    done = at < 0
    seen[rows[:, None], at] = True
    live = rows
    while len(live):
        open_like = np.where(done[live], -np.inf, like[live])
        pick = open_like.argmax(axis=1)
        more = open_like[np.arange(len(live)), pick] > -np.inf
        live, pick = live[more], pick[more]
        if not len(live):
            break
        done[live, pick] = True
        near = links[at[live, pick]]
        new = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        found = np.where(new, _likeness(g.vectors, near, queries[live]), -np.inf)
        all_like = np.concatenate([like[live], found], axis=1)
        top = np.argpartition(-all_like, width - 1, axis=1)[:, :width]
        like[live] = np.take_along_axis(all_like, top, 1)
        at[live] = np.take_along_axis(np.concatenate([at[live], np.where(new, near, -1)], axis=1), top, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~new], axis=1), top, 1)
    order = np.argsort(-like, axis=1, kind="stable")[:, :ef]
    return np.take_along_axis(at, order, 1), np.take_along_axis(like, order, 1)


def _diverse(vectors: np.ndarray, at: np.ndarray, like: np.ndarray, slots: int) -> np.ndarray:
    """Neighbours from candidates, best first: each nearer to the node than to those taken.

    Free slots go to the best of the rest.
    """
    order = np.argsort(-like, axis=1, kind="stable")
    at, like = np.take_along_axis(at, order, 1), np.take_along_axis(like, order, 1)
    valid = like > -np.inf
    own = vectors[at]
    between = np.matmul(own, own.transpose(0, 2, 1))
    taken = np.zeros(at.shape, dtype=bool)
    nearest = np.full(at.shape, -np.inf, dtype=np.float32)
    for j in range(at.shape[1]):
        ok = valid[:, j] & (taken.sum(axis=1) < slots) & (like[:, j] > nearest[:, j])
        taken[:, j] = ok
        nearest = np.where(ok[:, None], np.maximum(nearest, between[:, j]), nearest)
    rank = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :slots]
    out = np.where(np.take_along_axis(valid, rank, 1), np.take_along_axis(at, rank, 1), -1)
    if out.shape[1] < slots:
        out = np.pad(out, ((0, 0), (0, slots - out.shape[1])), constant_values=-1)
    return out


def _link(g: Graph, layer: int, nodes: np.ndarray, at: np.ndarray, like: np.ndarray) -> None:
    """Link new nodes to the best candidates, and those back to them."""
    links = g.layers[layer]
    slots = links.shape[1]
    links[nodes] = _diverse(g.vectors, at, like, min(M, slots))[:, :slots] if slots == M else np.pad(
        _diverse(g.vectors, at, like, M), ((0, 0), (0, slots - M)), constant_values=-1
    )
    source = np.repeat(nodes, slots)
    target = links[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    hubs, first, count = np.unique(target, return_index=True, return_counts=True)
    for a in range(0, len(hubs), _WAVE):
        h, f, c = hubs[a : a + _WAVE], first[a : a + _WAVE], count[a : a + _WAVE]
        fresh = np.full((len(h), c.max()), -1, dtype=np.int64)
        place = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        fresh[np.repeat(np.arange(len(h)), c), place] = source[f[0] : f[0] + c.sum()]
        both = np.concatenate([links[h], fresh], axis=1)
        # A link that is there already must not be counted twice.
        twice = (fresh[:, :, None] == links[h][:, None, :]).any(axis=2) & (fresh >= 0)
        both[:, slots:][twice] = -1
        likeness = np.where(both >= 0, _likeness(g.vectors, both, g.vectors[h]), -np.inf).astype(np.float32)
        room = (both >= 0).sum(axis=1) <= slots
        packed = np.argsort(both < 0, axis=1, kind="stable")[:, :slots]
        links[h[room]] = np.take_along_axis(both, packed, 1)[room]
        if (~room).any():
            links[h[~room]] = _diverse(g.vectors, both[~room], likeness[~room], slots)


def build(vectors: np.ndarray) -> Graph:
    """The graph of some vectors (none of them zero); nodes of high layers come first."""
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    n = len(unit)
    levels = _levels(n)
    order = np.lexsort((np.arange(n), -levels))
    layers = [np.full((n, 2 * M if i == 0 else M), -1, dtype=np.int64) for i in range(levels.max() + 1)]
    g = Graph(unit, levels, layers, int(order[0]))
    for begin in range(0, n, _WAVE):
        wave = order[begin : begin + _WAVE]
        among = unit[wave] @ unit[wave].T
        start = np.full((len(wave), 1), g.entry)
        for layer in range(len(layers) - 1, -1, -1):
            here = levels[wave] >= layer
            at, like = start, np.full(start.shape, -np.inf, dtype=np.float32)
            if begin:
                at, like = _search_layer(g, layer, unit[wave], start, EF_BUILD)
                start = at[:, :8] if at.shape[1] > 8 else at
            if here.any():
                # Members of a wave don't see each other in the graph: they are compared directly.
                peers = np.where(here[None, :] & (wave[:, None] != wave[None, :]), among, -np.inf)[here]
                best = np.argsort(-peers, axis=1, kind="stable")[:, :EF_BUILD]
                near = np.take_along_axis(peers, best, 1).astype(np.float32)
                _link(
                    g, layer, wave[here],
                    np.concatenate([at[here], wave[best]], axis=1), np.concatenate([like[here], near], axis=1),
                )
    return g


def search(g: Graph, queries: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
    """The ``k`` nearest nodes found for each query, nearest first; -1 fills up."""
    unit = (queries / np.linalg.norm(queries, axis=1, keepdims=True)).astype(np.float32)
    out = []
    for a in range(0, len(unit), _WAVE):
        part = unit[a : a + _WAVE]
        start = np.full((len(part), 1), g.entry)
        for layer in range(len(g.layers) - 1, 0, -1):
            start = _search_layer(g, layer, part, start, 8)[0]
        out.append(_search_layer(g, 0, part, start, max(ef, k))[0][:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), dtype=np.int64)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec as doubles) of the rows with an id and a finite vector that isn't zero."""
    vec = rows[vector].cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(vec, lambda x: x == 0.0)
    out = rows.select(rows[key].cast("bigint").alias("id"), vec.alias("vec"))
    return out.where(rows[key].isNotNull() & rows[vector].isNotNull() & ~F.coalesce(bad, F.lit(True)) & ~zero)


def build_index(rows: DataFrame, keep: int, rows_per_shard: int) -> tuple[DataFrame, int]:
    """The written index of ``usable`` rows, and its number of shards.

    One row for each distinct vector: dim, shard, node, vec, ids (the ``keep`` least ids that
    have it), links (layer 0, then the node's upper layers, one flat array). Equal vectors are
    found first, with a limit before the shuffle, so a vector that millions share is one node.
    Distinct vectors are dealt to shards by hash; a shard is one group of about
    ``rows_per_shard`` rows, whatever the table's size.
    """
    place = Window.partitionBy("vec").orderBy("id")
    ranked = rows.distinct().withColumn("n", F.row_number().over(place)).where(F.col("n") <= keep)
    nodes = staged(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    shards = max(1, -(-nodes.count() // rows_per_shard))
    dealt = nodes.select(
        F.size("vec").alias("dim"), F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("shard"), "vec", "ids"
    )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("ids", key=lambda s: s.map(lambda i: i[0])).reset_index(drop=True)
        g = build(np.stack(part["vec"].to_numpy()))
        part["node"] = np.arange(len(part), dtype=np.int32)
        part["links"] = [
            np.concatenate([g.layers[j][i] for j in range(level + 1)]).astype(np.int32)
            for i, level in enumerate(g.levels)
        ]
        return part[["dim", "shard", "node", "vec", "ids", "links"]]

    schema = "dim int, shard int, node int, vec array<double>, ids array<bigint>, links array<int>"
    return staged(dealt.groupBy("dim", "shard").applyInPandas(run, schema), "index"), shards


def _graph(part: pd.DataFrame) -> tuple[Graph, np.ndarray]:
    """A shard's graph from its index rows, and its vectors as they were."""
    part = part.sort_values("node")
    vectors = np.stack(part["vec"].to_numpy())
    links = part["links"].to_numpy()
    levels = np.array([(len(x) - 2 * M) // M for x in links])
    layers = [np.stack([x[: 2 * M] for x in links]).astype(np.int64)]
    for j in range(1, levels.max() + 1):
        layer = np.full((len(part), M), -1, dtype=np.int64)
        has = np.flatnonzero(levels >= j)
        layer[has] = np.stack([links[i][(j + 1) * M : (j + 2) * M] for i in has])
        layers.append(layer)
    unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    return Graph(unit, levels, layers, int(np.lexsort((np.arange(len(part)), -levels))[0])), vectors


def nearest(
    rows: DataFrame,
    asks: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    rows_per_shard: int = 4096,
    queries_per_block: int = 8192,
) -> DataFrame:
    """query_id, rank (from 1), ``key`` and score of the ``k`` nearest rows found.

    ``asks`` is a condition on the rows that are queries. Nearness is the cosine, computed on
    the original vectors in double precision; ties go to the smaller id. Candidates are all
    rows but those with the query's id. Rows with a null id, and vectors that are null, empty,
    zero, or hold null or non-finite parts, take no part; vectors of other lengths are no
    candidates. Repeated rows count once; an id with several vectors is searched with each,
    and its best results are returned.

    Queries in blocks meet shards by an equality join on (dim, shard, block); each pair of
    one block and one shard is a task's group of bounded size, and gives ``k`` rows a query.
    """
    held = usable(rows, key, vector)
    index, shards = build_index(held, k + 1, rows_per_shard)
    queries = staged(usable(rows.where(asks), key, vector).distinct(), "queries")
    blocks = max(1, -(-queries.count() // queries_per_block))
    asked = queries.select(
        F.col("id").alias("query_id"),
        "vec",
        F.size("vec").alias("dim"),
        F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    shown = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query_id bigint, id bigint, score double"

    def run(graph_rows: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(graph_rows) or not len(ask):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": int, "id": int})
        g, vectors = _graph(graph_rows)
        ids = graph_rows.sort_values("node")["ids"].to_numpy()
        asking = np.stack(ask["vec"].to_numpy())
        found = search(g, asking, k + 8)
        length = np.linalg.norm(vectors, axis=1)
        out: list[tuple] = []
        for q, v, at in zip(ask["query_id"].tolist(), asking, found, strict=True):
            at = at[at >= 0]
            score = vectors[at] @ v / (length[at] * np.linalg.norm(v))
            pairs = [(-s, i) for s, node in zip(score.tolist(), at.tolist(), strict=True) for i in ids[node] if i != q]
            out += [(q, i, -s) for s, i in sorted(pairs)[:k]]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    near = asked.groupBy("dim", "shard", "block")
    hits = shown.groupBy("dim", "shard", "block").cogroup(near).applyInPandas(run, schema)
    hits = hits.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
