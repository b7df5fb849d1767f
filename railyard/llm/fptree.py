"""Ranked lexical search: branch and bound over trees of frequency-ordered term vectors."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import staged

#: Items that are searched in one pass over the documents, and the bytes of their texts.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 16_000_000

#: Terms of all documents of one tree; more make another tree.
TREE_TERMS = 2_000_000

#: A branch with fewer leaves isn't bounded on its own.
LEAST_LEAVES = 16

#: A term is a run of ASCII letters and digits and of anything beyond ASCII.
_TERM_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased; null has none."""
    return (text or "").encode("utf-8").translate(_TERM_BYTES).split()


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of weight: rises with ``tf`` and falls with ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass
class Branch:
    """The children of a tree node: subtrees and, behind them, single term vectors.

    ``child`` and ``tf`` list for each of the rising ``terms`` (from ``start``) the children
    that hold it and the largest tf below each; ``m`` is the least m below each child. A
    vector's tf and m are its own, so its bound is its score.
    """

    terms: np.ndarray
    start: np.ndarray
    child: np.ndarray
    tf: np.ndarray
    m: np.ndarray
    subtrees: list[Branch]
    leaves: np.ndarray

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The most that a document below each child can score."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        found = self.terms[at] == terms
        at, weights = at[found], weights[found]
        size = self.start[at + 1] - self.start[at]
        ends = np.cumsum(size)
        spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - (ends - size), size)
        child = self.child[spots]
        total = np.zeros(len(self.m), dtype=np.int64)
        np.add.at(total, child, np.repeat(weights, size) * impact(self.tf[spots], self.m[child]))
        return total


class Tree:
    """Vectors of (term, tf), most frequent term first, that share the paths of a trie.

    Vectors are sorted, so that a trie node is a range of them. A node is kept if it holds at
    most half of the vectors of the node above that is kept; what hangs below others hangs
    below that one. So no vector lies below more nodes than the logarithm of their number,
    and the maxima of all nodes have a bounded size however deep the trie is.
    """

    def __init__(self, ids: list, terms: list[np.ndarray], tfs: list[np.ndarray], ms: np.ndarray):
        big = [t.astype(">u4").tobytes() for t in terms]
        order = sorted(range(len(ids)), key=lambda i: (big[i], tfs[i].tobytes(), ms[i], ids[i] is None, ids[i] or 0))
        #: Equal vectors with an equal m are one leaf: they score alike.
        self.ids: list[list] = []
        picked: list[int] = []
        for i in order:
            p = picked[-1] if picked else -1
            if picked and ms[i] == ms[p] and big[i] == big[p] and np.array_equal(tfs[i], tfs[p]):
                self.ids[-1].append(ids[i])
            else:
                picked.append(i)
                self.ids.append([ids[i]])
        self.m = ms[picked].astype(np.int64)
        self.size = np.array([len(terms[i]) for i in picked], dtype=np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.terms = np.concatenate([terms[i] for i in picked]).astype(np.int64)
        self.tfs = np.concatenate([tfs[i] for i in picked]).astype(np.int64)
        self.root = self._branch(0, len(picked), self._children(self._nodes()))

    def _shared(self) -> np.ndarray:
        """How many first terms each vector has in common with the one before it."""
        n = np.minimum(self.size[1:], self.size[:-1])
        ends = np.cumsum(n)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        a = self.terms[np.repeat(self.at[:-2], n) + within]
        b = self.terms[np.repeat(self.at[1:-1], n) + within]
        stop = np.where(a != b, within, np.iinfo(np.int64).max)
        shared = n.copy()
        some = np.flatnonzero(n)
        if len(some):
            first = np.minimum.reduceat(stop, (ends - n)[some])
            shared[some] = np.minimum(first, n[some])
        return shared

    def _nodes(self) -> list[tuple[int, int]]:
        """The ranges of vectors below the trie's branching nodes, outer ones first."""
        found, stack = [], []  # stack: depth and first vector of the open nodes
        for i, depth in enumerate([*self._shared().tolist(), 0], 1):
            first = i - 1
            while stack and stack[-1][0] > depth:
                first = stack.pop()[1]
                found.append((first, i))
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, first))
        return sorted(found, key=lambda r: (r[0], -r[1]))

    def _children(self, nodes: list[tuple[int, int]]) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """The kept nodes right below each kept node, the root included."""
        top = (0, len(self.ids))
        below: dict[tuple[int, int], list[tuple[int, int]]] = {top: []}
        path = [top]
        for node in nodes:
            while node[0] >= path[-1][1]:
                path.pop()
            above, size = path[-1], node[1] - node[0]
            if node != top and size >= LEAST_LEAVES and 2 * size <= above[1] - above[0]:
                below[above].append(node)
                below[node] = []
                path.append(node)
        return below

    def _maxima(self, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms below a node and the largest tf of each."""
        terms, tfs = self.terms[self.at[a] : self.at[z]], self.tfs[self.at[a] : self.at[z]]
        order = np.argsort(terms, kind="stable")
        terms, tfs = terms[order], tfs[order]
        first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else np.zeros(0, int)
        return terms[first], np.maximum.reduceat(tfs, first) if len(first) else tfs

    def _branch(self, a: int, z: int, below: dict) -> Branch:
        inner = below[(a, z)]
        leaf = np.ones(z - a, dtype=bool)
        for x, y in inner:
            leaf[x - a : y - a] = False
        leaves = np.flatnonzero(leaf) + a
        parts = [self._maxima(x, y) for x, y in inner]
        size = self.size[leaves]
        ends = np.cumsum(size)
        spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[leaves] - (ends - size), size)
        terms = np.concatenate([*(p[0] for p in parts), self.terms[spots]])
        tfs = np.concatenate([*(p[1] for p in parts), self.tfs[spots]])
        child = np.repeat(np.arange(len(inner) + len(leaves)), np.concatenate([np.array([len(p[0]) for p in parts], dtype=np.int64), size]))
        order = np.argsort(terms, kind="stable")
        terms, tfs, child = terms[order], tfs[order], child[order]
        start = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
        least = np.array([self.m[x:y].min() for x, y in inner], dtype=np.int64)
        return Branch(
            terms[start],
            np.append(start, len(terms)),
            child,
            tfs,
            np.concatenate([least, self.m[leaves]]),
            [self._branch(x, y, below) for x, y in inner],
            leaves,
        )

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """The ``k`` best (-score, no id, id) of ``best`` and this tree, best first.

        Depth first, and the most promising child first; a child is left out when its bound
        is below the score of the k-th.
        """
        floor = -best[-1][0] if len(best) == k else 1
        stack = [(np.iinfo(np.int64).max, self.root)]
        while stack:
            bound, branch = stack.pop()
            if bound < floor:
                continue
            bounds = branch.bounds(terms, weights)
            scores = bounds[len(branch.subtrees) :]
            hits = np.flatnonzero(scores >= floor)
            if len(hits):
                if len(hits) > k:
                    hits = hits[scores[hits] >= np.partition(scores[hits], -k)[-k]]
                for h in hits.tolist():
                    best = best + [(-int(scores[h]), i is None, i or 0) for i in self.ids[branch.leaves[h]][:k]]
                best = sorted(best)[:k]
                floor = -best[-1][0] if len(best) == k else 1
            for i in np.argsort(bounds[: len(branch.subtrees)], kind="stable").tolist():
                if bounds[i] >= floor:
                    stack.append((int(bounds[i]), branch.subtrees[i]))
        return best


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """key, n (terms with repeats), and terms and tfs restricted to the vocabulary."""
    kind = docs.schema["key"].dataType.simpleString()
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column(1):
                found = terms_of(text.as_py())
                sizes.append(len(found))
                held = Counter([t for t in map(number.get, found) if t is not None])
                terms.append(list(held.keys()))
                tfs.append(list(held.values()))
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, ints), pa.array(tfs, longs)],
                ["key", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(run, f"key {kind}, n bigint, terms array<int>, tfs array<bigint>")


def _best_of_parts(
    vectors: DataFrame, items: list[dict[int, int]], weights: dict[int, int], rank: dict[int, int], n: int, total: int, k: int
) -> DataFrame:
    """(item, key, score): the k best of each part of the documents for each item."""
    kind = vectors.schema["key"].dataType.simpleString()
    asked = []
    for item in items:
        held = sorted((rank[t], c * weights[t]) for t, c in item.items() if weights.get(t))
        asked.append((np.array([h[0] for h in held], dtype=np.int64), np.array([h[1] for h in held], dtype=np.int64)))
    place = np.zeros(max(rank, default=-1) + 1, dtype=np.int64)
    place[list(rank)] = list(rank.values())
    shared = vectors.sparkSession.sparkContext.broadcast((asked, place))

    def trees(batches: Iterator[pa.RecordBatch], place: np.ndarray) -> Iterator[Tree]:
        ids, terms, tfs, ms, held = [], [], [], [], 0

        def tree() -> Tree:
            return Tree(ids, terms, tfs, np.array(ms, dtype=np.int64))

        for batch in batches:
            size = batch.column(1).to_numpy()
            m = 75 + 25 * size * n // total
            offsets = batch.column(2).offsets.to_numpy()
            all_terms = batch.column(2).values.to_numpy()
            all_tfs = batch.column(3).values.to_numpy()
            for i, key in enumerate(batch.column(0).to_pylist()):
                t, f = place[all_terms[offsets[i] : offsets[i + 1]]], all_tfs[offsets[i] : offsets[i + 1]]
                order = np.argsort(t)
                ids.append(key)
                terms.append(t[order])
                tfs.append(f[order])
                ms.append(m[i])
                held += len(t)
                if held >= TREE_TERMS:
                    yield tree()
                    ids, terms, tfs, ms, held = [], [], [], [], 0
        if ids:
            yield tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, place = shared.value
        best: list[list[tuple]] = [[] for _ in asked]
        for tree in trees(batches, place):
            for i, (terms, weights) in enumerate(asked):
                if len(terms):
                    best[i] = tree.search(terms, weights, best[i], k)
        rows = [(i, None if none else key, -score) for i, found in enumerate(best) for score, none, key in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows]).cast(key_type),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["item", "key", "score"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(vectors.schema["key"].dataType)
    held = vectors.where(F.size("terms") > 0)
    return held.mapInArrow(run, f"item int, key {kind}, score bigint")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The query set, block by block: the only rows that come to the driver."""
    block, size = [], 0
    for item, text in items.toLocalIterator():
        block.append((item, text))
        size += len(text or "")
        if len(block) == BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``top`` best documents for every item: ``item_key``, rank, ``key``, score.

    The score sums w * ((10**9 * tf) div (1000 * tf + 12 * m)) over the item's terms, repeats
    included; w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + (25 * n * N) div L.
    Best first, equal scores by key, null keys last; only scores above 0.

    Documents become vectors of the query set's terms with global statistics, and each part
    of them trees (``Tree``), searched for every item; the parts' best are merged. Items are
    read in blocks, each a pass over the documents.

    Null and empty texts on either side match nothing. Repeated documents are ranked each;
    items that share an id are ranked one by one, each with ranks from 1. Whole texts of any
    length count. Empty tables give an empty table; other columns may have any names.
    """
    spark = docs.sparkSession
    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    asked = items.select(items[item_key].alias("item"), items[item_text].alias("text"))
    out = None
    for block in _blocks(asked):
        words = [Counter(terms_of(t)) for _, t in block]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for w in words for t in w))}
        counted = [{vocabulary[t]: c for t, c in w.items()} for w in words]
        vectors = staged(_vectors(source, vocabulary), "fp-vectors")
        n, total = vectors.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        # One row for each term of the block.
        df = {r["t"]: r["df"] for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
        order = sorted(range(len(vocabulary)), key=lambda t: (-df.get(t, 0), t))
        rank = {t: i for i, t in enumerate(order)}
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
        best = _best_of_parts(vectors, counted, weights, rank, n, total or 1, top)
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key")))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
        names = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(block)], f"no int, item_id {asked.schema['item'].dataType.simpleString()}"
        )
        ranked = best.join(F.broadcast(names), F.col("item") == F.col("no")).select(
            F.col("item_id").alias(item_key), "rank", F.col("key").alias(key), "score"
        )
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return asked.join(source, F.lit(False)).select(
            F.col("item").alias(item_key), F.lit(0).alias("rank"), F.col("key").alias(key), F.lit(0).cast("long").alias("score")
        )
    return out
