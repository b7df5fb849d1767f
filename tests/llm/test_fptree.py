import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from railyard.llm import fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(rows, items, top):
    counts = [Counter(brute_terms(t)) for _, t, _ in rows]
    n = sum(1 for c in counts if c)
    total = sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, _, _), c in zip(rows, counts, strict=True):
            m = 100 - 25 + (25 * sum(c.values()) * n) // max(total, 1)
            score = 0
            for t in brute_terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for r, (score, none, doc) in enumerate(sorted(found)[:top], 1):
            out.append((item, r, None if none else doc, -score))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def texts_of(rng, n):
    words = [a + b for a in "ba bé bi do du fa ca mo ni".split() for b in "l m n r s t".split()]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60))), "a") for i in range(n)]


def ask(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, doc_id string, rank int")


@pytest.mark.parametrize("tree_terms", [300, 1_000_000])
def test_against_all_scores(spark, frame, odd_rows, monkeypatch, tree_terms):
    monkeypatch.setattr(fptree, "TREE_TERMS", tree_terms)
    monkeypatch.setattr(fptree, "LEAST_LEAVES", 2)
    rng = random.Random(2)
    rows = odd_rows + [(i + 500, t, s) for i, t, s in texts_of(rng, 300)]
    rows += [(900 + i, rows[40][1], "b") for i in range(50)]  # copies tie
    items = [(i, t) for i, t, _ in texts_of(rng, 25)]
    items += [(50, None), (51, ""), (52, "Bal BAL bal-bal"), (53, rows[40][1]), (None, "bam"), (3, "bén é" + "é" * 39)]
    got = fptree.rank_documents(frame(rows), ask(spark, items), top=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(rows, items, 7)
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3])) == want


def test_blocks_of_items_give_the_same(spark, frame, monkeypatch):
    rng = random.Random(8)
    rows, items = texts_of(rng, 60), [(i, t) for i, t, _ in texts_of(rng, 9)]
    monkeypatch.setattr(fptree, "BLOCK_ITEMS", 4)
    got = fptree.rank_documents(frame(rows), ask(spark, items), top=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, items, 5)


def test_empty_tables(spark, frame):
    assert fptree.rank_documents(frame([]), ask(spark, [(1, "bal")])).count() == 0
    empty = fptree.rank_documents(frame([(1, "bal", "a")]), ask(spark, []))
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0


def test_bounds_hold_and_cut_branches():
    rng = np.random.default_rng(3)
    terms, tfs = [], []
    for _ in range(3000):
        held = np.sort(rng.choice(200, rng.integers(1, 12), replace=False, p=(p := 1 / np.arange(1, 201)) / p.sum()))
        terms.append(held)
        tfs.append(rng.integers(1, 6, len(held)))
    tree = fptree.Tree(list(range(3000)), terms, tfs, rng.integers(75, 300, 3000))
    asked, weights = np.array([0, 3, 70, 150]), np.array([50, 400, 3000, 5000])
    seen = []

    def walk(branch):
        """The best score below each branch never passes the bound that stands above it."""
        bounds = branch.bounds(asked, weights)
        best = bounds[len(branch.subtrees) :].max(initial=0)
        for bound, sub in zip(bounds, branch.subtrees, strict=False):
            below = walk(sub)
            assert below <= bound
            best = max(best, below)
        seen.append(branch)
        return best

    best = walk(tree.root)
    assert tree.search(asked, weights, [], 5)[0][0] == -best
    visited = []
    full = fptree.Branch.bounds
    try:
        fptree.Branch.bounds = lambda self, t, w: visited.append(self) or full(self, t, w)
        tree.search(asked, weights, [], 5)
    finally:
        fptree.Branch.bounds = full
    assert len(seen) > 20 and len(visited) < 0.7 * len(seen)
