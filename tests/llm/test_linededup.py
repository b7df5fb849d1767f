import random
import re

from railyard.llm import linededup

from tests.llm.conftest import prose


def brute(docs, least):
    """Lines of runs of ``least`` words or more that also begin at an earlier place."""
    lines = []  # of documents in order: [(line number, body, words)]
    for text in docs:
        found = [(i, x.strip(" \t\x0b\x0c\r"), len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate((text or "").split("\n"))]
        lines.append([x for x in found if x[2]])
    gone = [set() for _ in docs]
    flat = [(d, k) for d in range(len(docs)) for k in range(len(lines[d]))]
    for n, (d, k) in enumerate(flat):
        for e, j in flat[:n]:
            size = words = 0
            while (
                k + size < len(lines[d]) and j + size < len(lines[e])
                and lines[d][k + size][1] == lines[e][j + size][1]
            ):
                words += lines[d][k + size][2]
                size += 1
            if words >= least:
                gone[d].update(range(lines[d][k][0], lines[d][k + size - 1][0] + 1))
    return ["\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) if t else t for d, t in enumerate(docs)]


def test_against_brute_force(frame):
    rng = random.Random(1)
    for least in (10, 25):
        passages = [[prose(rng, rng.randint(1, 14)) for _ in range(rng.randint(1, 6))] for _ in range(12)]
        docs = []
        for _ in range(60):
            parts = []
            for _ in range(rng.randint(0, 5)):
                part = list(rng.choice(passages))
                a = rng.randrange(len(part))
                parts += rng.choice([part, part[a:], [prose(rng, rng.randint(0, 9))], ["", part[0] + "  "]])
            docs.append("\n".join(parts))
        rows = [(i, t, "s") for i, t in enumerate(docs)]
        got = linededup.dedup_lines(frame(rows), min_words=least).orderBy("doc_id").collect()
        assert [r["text"] for r in got] == brute(docs, least)


def test_odd_rows(frame, odd_rows):
    docs = frame(odd_rows)
    out = linededup.dedup_lines(docs, report=True)
    assert out.columns == [*docs.columns, "lines", "removed_lines"]
    got = [(r["doc_id"], r["text"], r["removed_lines"]) for r in out.collect()]
    assert len(got) == len(odd_rows)
    same = odd_rows[5][1]
    assert got.count((6, same, 0)) == 2  # equal rows are one document
    assert (7, "", 1) in got and (None, "", 1) in got and (None, None, 0) in got
    assert (1, None, 0) in got and (2, "", 0) in got and (3, " \t\n", 0) in got
    assert (5, odd_rows[4][1], 0) in got
    assert linededup.dedup_lines(frame([])).count() == 0


def test_a_shared_passage_stays_once(frame):
    rng = random.Random(2)
    passage = prose(rng, 51)
    rows = [(i, f"{prose(rng, 60)}\n{passage}\n{prose(rng, 5)} {i}\nshort line", "s") for i in range(50)]
    out = linededup.dedup_lines(frame(rows)).orderBy("doc_id").collect()
    assert [passage in r["text"] for r in out] == [True] + [False] * 49
    assert all("short line" in r["text"] for r in out)


def test_every_long_enough_run_holds_a_mark(frame):
    rng = random.Random(7)
    rows = [(i, "\n".join(prose(rng, rng.randint(1, 14)) for _ in range(60)), "s") for i in range(20)]
    lines = linededup._lines(frame(rows), "doc_id", "text")
    marked = {(r["key"], r["mark_pos"]) for r in linededup.marks(lines, 50).collect()}
    found = {}
    for r in lines.collect():
        found.setdefault(r["key"], []).append((r["pos"], r["words"]))
    assert len(marked) < 0.6 * sum(map(len, found.values()))
    for doc, of in found.items():
        of.sort()
        for i in range(len(of)):
            words, j = 0, i
            while j < len(of) and words < 50:
                words, j = words + of[j][1], j + 1
            assert words < 50 or any((doc, pos) in marked for pos, _ in of[i:j])


def test_matches_come_from_the_marks(frame, monkeypatch):
    rng = random.Random(2)
    passage = prose(rng, 51)
    docs = frame([(i, f"{prose(rng, 60)}\n{passage}", "s") for i in range(5)])
    assert linededup.dedup_lines(docs, report=True).selectExpr("sum(removed_lines)").first()[0] == 4
    plain = linededup.marks
    monkeypatch.setattr(linededup, "marks", lambda lines, n: plain(lines, n).limit(0))
    assert linededup.dedup_lines(docs, report=True).selectExpr("sum(removed_lines)").first()[0] == 0


def test_report_replaces_columns_of_its_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", 9, 8)], "doc_id int, text string, lines int, removed_lines int")
    assert linededup.dedup_lines(docs, report=True).first().asDict() == {"doc_id": 1, "text": "a\nb", "lines": 2, "removed_lines": 0}
