import random
import re

import numpy as np
import pytest

from railyard.llm import oddsketch


def brute_set(text, words=5):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or {tuple(found)}


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [brute_set(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _, _), s) in enumerate(zip(rows, sets, strict=True))]


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


@pytest.mark.parametrize("joined", [2, 32])
def test_against_all_pairs(frame, odd_rows, monkeypatch, joined):
    monkeypatch.setattr(oddsketch, "JOINED_BUCKET", joined)
    monkeypatch.setattr(oddsketch, "CHUNK_ROWS", 8)
    rng = random.Random(21)
    rows = list(odd_rows)
    bases = [t for _, t, _ in odd_rows if t and len(t.split()) > 50][:12]
    for i in range(160):  # near copies around the threshold, and chains of them
        base = rng.choice(bases[1:])
        text = edited(rng, base, rng.randint(0, 4))
        rows.append((100 + i, text.upper() if i % 9 == 0 else text, "a"))
        if i % 3 == 0:
            bases.append(text)
    got = oddsketch.near_duplicates(frame(rows)).collect()
    assert in_order((r[0], r[1], r[2]) for r in got) == in_order(brute(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_group_of_near_copies_and_of_exact_ones(frame):
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(400)}" for _ in range(200))
    rows = [(i, base, "a") for i in range(400)]
    rows += [(1000 + i, edited(rng, base, rng.randint(1, 5)), "a") for i in range(200)]
    got = oddsketch.near_duplicates(frame(rows)).collect()
    assert in_order((r[0], r[1], r[2]) for r in got) == in_order(brute(rows))


def test_bitmaps_estimate_the_similarity():
    rng = np.random.default_rng(1)
    limit = oddsketch.allowed_bits(85)
    for share in (0.85, 0.9, 0.97):
        errors = []
        for _ in range(60):
            common = rng.integers(0, 1 << 63, int(1000 * share)).astype(np.uint64)
            rest = rng.integers(0, 1 << 63, (2, (1000 - len(common)) // 2)).astype(np.uint64)
            a, b = (oddsketch.samples(np.concatenate([common, r])) for r in rest)
            differing = int(np.bitwise_count(oddsketch.odd_sketch(a) ^ oddsketch.odd_sketch(b)).sum())
            assert differing <= 2 * int((a != b).sum()) and (share < 0.85 or differing <= limit)
            errors.append(oddsketch.estimate(differing) - share)
        assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.045
    assert oddsketch.allowed_bits(100) == 0 and oddsketch.estimate(0) == 1.0


def test_common_counts():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in (0, 5, 30, 90, 1)]
    got = oddsketch.common_counts(sets[:2], sets[1:], columns=7)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets[:2]]


def test_empty_table_and_blank_texts(frame):
    assert oddsketch.near_duplicates(frame([])).count() == 0
    blank = oddsketch.near_duplicates(frame([(2, " ", "a"), (1, None, "a"), (None, "", "b")])).collect()
    assert in_order(tuple(r) for r in blank) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]


def test_long_texts(frame, odd_rows):
    long = odd_rows[4][1] * 4
    rows = [(1, long, "a"), (2, long + " end", "a"), (3, "x" * 1_000_000, "a"), (4, "X" * 1_000_000, "a")]
    got = oddsketch.near_duplicates(frame(rows)).collect()
    assert in_order((r[0], r[1], r[2]) for r in got) == in_order(brute(rows))
