import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from railyard.llm import mixing
from tests.llm.conftest import prose


def water_fill(sizes, weights, share, most):
    budget, capped = sum(sizes.values()) * share, set()
    while True:
        free = [s for s in sizes if s not in capped and weights[s] > 0]
        if not free:
            return {s: most * sizes[s] if s in capped else 0.0 for s in sizes}
        level = (budget - sum(most * sizes[s] for s in capped)) / sum(weights[s] for s in free)
        above = {s for s in free if level * weights[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else level * weights[s] for s in sizes}
        capped |= above


def test_targets_and_draws(frame, odd_rows):
    rows = odd_rows + [(1000 + i, "w " * (i % 7), "b") for i in range(300)]
    docs = frame(rows)
    got = mixing.taken_words(docs, mixing.cyclic_weights(docs, "source", (3, 1, 2))).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    ranked = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ranked)}
    want = water_fill(sizes, weights, 1.5, 2.0)
    assert len(got) == len(rows)
    taken, source_of = defaultdict(int), {}
    for doc, text, source in rows:
        source_of.setdefault((doc, size(text)), source)
    for r in got:
        source = source_of[r["doc_id"], r["size"]]
        taken[source] += r["taken"]
        assert r["target"] == pytest.approx(want[source]) and r["source_size"] == sizes[source]
        assert r["taken"] <= 2 * r["size"]
    again = mixing.taken_words(docs.repartition(7), mixing.cyclic_weights(docs, "source", (3, 1, 2)))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    largest = defaultdict(int)
    for _, text, source in rows:
        largest[source] = max(largest[source], size(text))
    for source in sizes:  # nearest whole rows
        assert abs(taken[source] - want[source]) <= largest[source]


def test_mixed_rows_keep_their_columns(frame, odd_rows):
    docs = frame(odd_rows)
    weights = mixing.cyclic_weights(docs, "source", (3, 1, 2))
    words = {}
    for r in mixing.taken_words(docs.select("doc_id", "source", "text"), weights).collect():
        words[r["doc_id"], r["size"]] = words.get((r["doc_id"], r["size"]), 0) + r["taken"]
    out = mixing.mix(docs.select("text", "source", "doc_id"), weights)
    assert out.columns == ["text", "source", "doc_id"]
    total = sum(len((r["text"] or "").split()) for r in out.collect())
    assert total == sum(words.values())
    # Other columns tell rows apart too, so the draws are others, not the targets.
    wide = mixing.mix(docs, weights)
    assert wide.columns == docs.columns
    assert abs(sum(len((r["text"] or "").split()) for r in wide.collect()) - total) < 0.1 * total
    assert mixing.mix(frame([]), mixing.cyclic_weights(frame([]), "source", (3, 1, 2))).count() == 0


def test_infeasible_budget_is_clamped(spark, frame):
    docs = frame([(1, "a b", "x"), (2, "c", "y"), (3, None, "z")])
    weights = spark.createDataFrame([("x", 1), ("y", 5), ("other", 9)], "source string, weight bigint")
    got = {r["doc_id"]: r for r in mixing.taken_words(docs, weights, share=9.0).collect()}
    assert [got[i]["taken"] for i in (1, 2, 3)] == [4, 2, 0]


def test_null_and_repeated_keys_reach_the_target(frame):
    rng = random.Random(3)
    rows = [(None if i < 900 else i, prose(rng, rng.randint(1, 20)), "a") for i in range(1000)]
    rows += [(5, "one two three four", "b")] * 700 + [(None, "x y", "c")] * 400 + [(6, "z", "c")] * 5
    docs = frame(rows)
    weights = mixing.cyclic_weights(docs, "source", (3, 1, 2))
    want = {}
    taken = defaultdict(int)
    got = mixing.taken_words(docs, weights).collect()
    assert len(got) == len(rows)
    for r in got:
        taken[r["source_size"]] += r["taken"]
        want[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - want[s]) <= 20 for s in want) and len(want) == 3
    out = mixing.mix(docs, weights)
    words = defaultdict(int)
    for r in out.collect():
        words[r["source"]] += len(r["text"].split())
    assert all(min(abs(w - t) for t in want.values()) <= 20 for w in words.values())


def test_helper_names_may_be_taken(spark):
    rows = [(i, f"w{i} " * (i % 5), "ab"[i % 2], 77, "k", 3) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, __repeats int, __plan string, copy int")
    out = mixing.mix(docs, mixing.cyclic_weights(docs, "source", (3, 1, 2)))
    assert out.columns == docs.columns and {(r["__repeats"], r["__plan"], r["copy"]) for r in out.collect()} == {(77, "k", 3)}


def test_very_many_copies_are_counted_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_COPIES", 7)
    rows = spark.createDataFrame([("a", 30), ("b", 7), ("c", 1)], "k string, n bigint")
    got = mixing._each_copy(rows, "n", "copy").collect()
    assert sorted((r["k"], r["copy"]) for r in got) == [(k, i) for k, n in (("a", 30), ("b", 7), ("c", 1)) for i in range(1, n + 1)]


def test_draw_is_md5(spark):
    row = spark.range(1).select(mixing.draw(F.lit("name"), 1).alias("d")).first()
    assert row["d"] == int(hashlib.md5(b"name|1").hexdigest()[:15], 16)
