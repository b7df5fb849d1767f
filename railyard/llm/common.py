"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import work_dir

#: A word of the corpus: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends here.

    A lost executor costs only the tasks that ran on it; the table is never recomputed.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of the filters below; a filter is a table of at most 2**18 rows, whatever it holds.
FILTER_BITS = 1 << 24


def bit_filter(values: Column, rows: DataFrame, word: str, mask: str) -> DataFrame:
    """(word, mask): the bits that the hashes of some values set in a bitmap of fixed size."""
    bit = F.pmod(F.xxhash64(values), F.lit(FILTER_BITS))
    return (
        rows.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias(word))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias(mask))
    )


def bit_hit(value: Column, word: str, mask: str) -> Column:
    """Whether a value may be in the filter; never false for one that is."""
    bit = F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))
    held = F.call_function("shiftrightunsigned", F.col(mask), (bit % 64).cast("int"))
    return (F.shiftright(bit, 6) == F.col(word)) & (held.bitwiseAND(F.lit(1).cast("bigint")) == 1)


def word_count(text: Column) -> Column:
    """Words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_spans(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of every word of texts laid end to end.

    ``doc_starts`` are the bytes where a text begins; no word crosses one.
    """
    letter = ~_SPACE[data]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    inner = doc_starts[(doc_starts > 0) & (doc_starts < len(data))]
    first[inner] = letter[inner]
    last[inner - 1] = letter[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept by the worker."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(n, base, dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, wherever the word stands."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def byte_slices(texts: list[bytes] | list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes each, so that temporaries stay small."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    train: Column,
    rows_per_class: int,
    max_chars: int,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """A bounded sample of labelled texts for fitting, and all training rows of each class.

    Of each class (0 and 1) the ``rows_per_class`` ids with the least hash, without texts
    above ``max_chars``: at most twice that many rows come to the driver, however large the
    tables are. ``train`` is a condition on the labels' rows. Rows with a null id or label
    are left out; an id with both labels counts as 1; of equal ids one text is read.
    """
    rows = labels.where(train & labels[key].isNotNull() & labels[label].isin(0, 1))
    rows = rows.groupBy(labels[key].alias("id")).agg(F.max(labels[label]).cast("int").alias("y"))
    rows = staged(rows, "labels")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    order = F.xxhash64("id"), F.col("id")
    picked = rows.where("y = 0").orderBy(*order).limit(rows_per_class)
    picked = picked.unionByName(rows.where("y = 1").orderBy(*order).limit(rows_per_class))
    texts = docs.select(docs[key].alias("doc"), docs[text].alias("text")).where(F.length("text") <= max_chars)
    found = texts.join(F.broadcast(picked), F.col("doc") == F.col("id")).dropDuplicates(["id"])
    sample = found.select("id", "text", "y").toPandas().sort_values("id")
    return list(zip(sample["text"], sample["y"].astype(int), strict=True)), counts


def class_weights(ys: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give a sample the class shares of all training rows."""
    weights = np.ones(len(ys))
    for y in (0, 1):
        if (ys == y).any():
            weights[ys == y] = max(counts.get(y, 0), 1) / (ys == y).sum()
    return weights / weights.mean() if len(ys) else weights


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression, by Newton steps.

    ``y`` may be probabilities. Meant for few columns.
    """
    full = np.column_stack([x, np.ones(len(x))])
    keep = np.append(np.full(x.shape[1], ridge), 1e-6) * max(len(x), 1)
    beta = np.zeros(full.shape[1])

    def loss(b: np.ndarray) -> float:
        z = full @ b
        return float(weights @ (np.logaddexp(0, z) - y * z) + 0.5 * keep @ (b * b))

    now = loss(beta)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -40, 40)))
        slope = full.T @ (weights * (p - y)) + keep * beta
        curve = (full * (weights * p * (1 - p))[:, None]).T @ full + np.diag(keep + 1e-9)
        step, scale = np.linalg.solve(curve, slope), 1.0
        while scale > 1e-4 and loss(beta - scale * step) > now:
            scale /= 2
        beta = beta - scale * step
        before, now = now, loss(beta)
        if before - now < 1e-9 * (1 + abs(now)):
            break
    return beta
