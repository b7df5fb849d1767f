import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " key string, size string, digest string, fp string, rank string, __draw string,"
    " __copies string, __runs string, __repeats string, cls string, `plan` string"
)
WORDS = [a + b for a in "ba be bi do du fa".split() for b in "l m n r s t".split()]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture
def frame(spark):
    """Documents with every odd case, and columns whose names operators also use."""

    def make(rows):
        full = [(i, t, "en", s, len(t or ""), "k", "s", "d", "f", "r", "w", "c", "u", "p", "l", "n") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    rng = random.Random(5)
    long = prose(rng, 30_000)
    same = prose(rng, 80)
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, long, "b"),
        (6, same, "a"), (6, same, "a"), (7, same, "c"), (None, same, "c"), (None, None, None),
        (8, same.replace(" ", "\n", 3), "b"), (8, prose(rng, 60), "b"), (9, "é" * 40, "a"),
    ]
    return rows + [(20 + i, prose(rng, rng.randint(1, 120)), rng.choice("abc")) for i in range(40)]
