import hashlib
import re

import numpy as np
import pytest

from railyard.llm import sketch


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def test_against_brute_force(frame, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and odd_rows.count(r) == 1 and r[0] not in (8,)]
    for per_range in (4, 1000):
        got = {r["doc_id"]: r for r in sketch.fingerprint_edits(frame(rows), rows=per_range).collect()}
        line = order(rows)
        assert len(got) == len(rows)
        for i, (doc, text, _) in enumerate(line):
            text, after = text or "", line[(i + 1) % len(line)][1] or ""
            half = len(text) // 2
            changed = text[: len(text) - half] + after[:half]
            row = got[doc]
            assert row["n_chars"] == len(text)
            assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            for other, near in ((changed, row["near_edited"]), (after, row["near_next"])):
                a, b = shingles(text), shingles(other)
                want = len(a & b) / len(a | b) if a | b else 1.0
                assert near == pytest.approx(want, abs=0.2 if len(a | b) > 60 else 1e-12)


def test_odd_rows_and_empty_table(frame, odd_rows):
    rows = sketch.fingerprint_edits(frame(odd_rows), rows=5).collect()
    assert len(rows) == len(odd_rows)
    by_text = {}
    for doc, text, _ in odd_rows:
        mine = {r["fingerprint"] for r in rows if r["doc_id"] == doc and r["n_chars"] == len(text or "")}
        by_text.setdefault(text or "", set()).update(mine)
    assert all(len(found) == 1 for found in by_text.values())
    assert sketch.fingerprint_edits(frame([])).count() == 0
    (one,) = sketch.fingerprint_edits(frame([(3, "a b c", "s")])).collect()
    assert one["near_next"] == 1.0


def test_sketches_merge_and_estimate_containment():
    part = " ".join(f"w{i}" for i in range(3000))
    whole = part + " " + " ".join(f"v{i}" for i in range(60_000))
    a, b = sketch.sketches([part.encode(), whole.encode()])
    assert sketch.compare(a, b)[1] == 1.0
    rest = sketch.sketches([" ".join(whole.split()[2996:]).encode()])[0]
    assert np.array_equal(sketch.merge(a, rest), b)
    assert np.array_equal(sketch.from_text(sketch.as_text(a)), a)
