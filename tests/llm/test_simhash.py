import random
import re

import xxhash

from railyard.llm import components, simhash


def brute_fingerprint(text, words=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values):
    """The least member that links of two bits or fewer reach, for each value."""
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    line = list(values)
    for i, a in enumerate(line):
        for b in line[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_links_by_entries_and_by_flips(spark, monkeypatch):
    rng = random.Random(3)
    values = {0, 3, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(40):
            v = base
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.choice([rng.randrange(64), rng.randrange(12), 32 + rng.randrange(12)])
            values.add(v)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    want = classes(values)
    for joined in (1, 3, 64):
        monkeypatch.setattr(simhash, "JOINED_ENTRY", joined)
        roots = {r["node"]: r["root"] for r in components.components(simhash.links(df)).collect()}
        got = {v: roots.get(signed(v), signed(v)) for v in values}
        assert len(set(got.values())) == len(set(want.values()))
        assert all((got[a] == got[b]) == (want[a] == want[b]) for a in values for b in values)


def test_near_duplicates_against_brute_force(frame, odd_rows):
    rng = random.Random(9)
    rows = list(odd_rows)
    for i in range(60):  # long texts with one word changed
        words = rows[4][1].split()[:3000]
        words[rng.randrange(3000)] = "changed"
        rows.append((100 + i, " ".join(words), "a"))
    prints = {text: brute_fingerprint(text) for _, text, _ in rows}
    linked = classes(set(prints.values()))
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            root = linked[prints[text]]
            least[root] = min(least.get(root, doc), doc)
    got = simhash.near_duplicates(frame(rows)).collect()
    want = sorted((doc is None, doc or 0, f"{prints[t]:016x}", least.get(linked[prints[t]])) for doc, t, _ in rows)
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in got) == want

    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame([]).columns
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == len({linked[prints[t]] for t in texts}) == len(set(linked.values()))


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.keep_one(frame([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    roots = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert roots == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 140)}
