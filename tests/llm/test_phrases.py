import random
import re
from collections import Counter

import numpy as np
import pytest

from railyard.llm import phrases


def brute_counts(rows):
    """f of every phrase of 1 to 4 words by language, and all words of each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[(lang or "und", *words[i : i + k])] += 1
    return f, n


def brute(rows, least, top, cover=80):
    f, n = brute_counts(rows)
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = set()
    for p, a in candidates.items():
        for s in range(2, len(p) - 1):
            for i in range(1, len(p) - s + 1):
                inner = (p[0], *p[i : i + s])
                if 100 * a >= cover * f[inner]:
                    gone.add(inner)
    out = []
    for lang in n:
        found = []
        for p, a in candidates.items():
            if p[0] != lang or p in gone:
                continue
            cuts = []
            for k in range(1, len(p) - 1):
                left, right = f[p[: k + 1]], f[(lang, *p[k + 1 :])]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p[1:]).encode(), left, right))
        for r, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def make(spark, rows):
    return spark.createDataFrame(
        [(t, g, 1, 2, "x") for g, t in rows], "text string, lang string, k int, n int, phrase string"
    )


def prose(rng, n):
    fixed = ["new york", "new york city", "de la casa", "as well as", "ice cream cone day", "x1 x2 x3 x4"]
    words = [a + b for a in "ab cd e".split() for b in "l m n r".split()]
    out = []
    for _ in range(n):
        out.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words))
        if rng.random() < 0.1:
            out.append(rng.choice([",", ". ", "\n", "\t", "  "]))
    return " ".join(out)


@pytest.mark.parametrize("shard_words, range_arcs, bits", [(150, 40, 1 << 25), (2_000_000, 400_000, 64)])
def test_against_brute_force(spark, monkeypatch, shard_words, range_arcs, bits):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(phrases, "RANGE_ARCS", range_arcs)
    monkeypatch.setattr(phrases, "_MARK_EVERY", 16)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rng = random.Random(6)
    rows = [(rng.choice(["en", "en", "fr", None]), prose(rng, rng.randint(1, 60))) for _ in range(90)]
    rows += [("en", None), ("fr", ""), ("und", "New York City, NEW york city!"), ("de", "É é É é É é")]
    rows += [("en", "copy of the same words here " * 4)] * 12 + [("fr", "long " * 3000), ("de", "y" * 50_000)]
    for least, top in ((3, 1000), (8, 5)):
        got = phrases.collocations(make(spark, rows), top=top, least=least)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_empty_and_rare(spark):
    assert phrases.collocations(make(spark, [])).count() == 0
    assert phrases.collocations(make(spark, [("en", "one two three"), (None, None)])).count() == 0


def some_counts(rows):
    """The counts of all n-grams of each text; orders from 1 on pass any filter."""
    every = np.full(4, 2**64 - 1, dtype=np.uint64)
    parts = []
    for shard in phrases.encode_shards(iter(rows), 1):
        shard = phrases.Shard.unpack(*shard.pack())
        parts += [shard.counts(1, 1, None), shard.counts(2, 2, every), shard.counts(3, 4, every)]
    return parts


def told(counts):
    return {tuple(counts.words[i] for i in p): w for _, paths, ws in counts.rows() for p, w in zip(paths.tolist(), ws.tolist())}


def test_automata_keep_sum_cut_and_compose():
    rng = random.Random(1)
    rows = [(rng.choice(["en", "fr"]), prose(rng, 80)) for _ in range(6)]
    parts = some_counts(rows)
    want, _ = brute_counts(rows)
    want = {tuple(w.encode() for w in p): c for p, c in want.items()}
    whole = phrases.Counts.union(parts)
    assert told(whole) == want
    automaton = phrases.Automaton.of(whole)
    assert sum(map(len, automaton.labels)) < whole.arcs()  # shared ends
    again = phrases.Automaton.unpack(automaton.pack())
    assert told(again.counts()) == want
    bounds = whole.marks(29)
    pieces = list(whole.cut(bounds))
    assert len(pieces) == len(bounds) + 1
    met = {}
    for i, piece in pieces:
        for p, c in told(piece).items():
            assert (not i or p >= bounds[i - 1]) and (i == len(bounds) or p < bounds[i])
            met[p] = met.get(p, 0) + c
    assert met == want
    assert told(whole.at_least(5)) == {p: c for p, c in want.items() if c >= 5}
    asked = [p for p in want if len(p) == 3] + [(b"en", b"no", b"new"), (b"fr", b"casa", b"york")]
    assert again.compose(asked).tolist() == [want.get(p, 0) for p in asked]
