"""Threshold-scaled sketches: every shingle hash below a fixed fraction is kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from railyard.llm.common import byte_slices, mix64, staged, word_hashes, word_spans

WORDS = 5
#: Of all hashes this fraction is kept, and at least so many of the smallest.
FRACTION = 1 / 16
LEAST = 64

_LIMIT = np.uint64(int(2**64 * FRACTION))
_END = np.uint64(2**64 - 1)
_PLACES = mix64(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def sketches(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sketch of each text: sorted distinct hashes of its shingles.

    A shingle is ``words`` neighbouring words; a shorter text is one shingle, a text without
    words has none. Kept are all hashes below the fraction; if those are fewer than ``LEAST``,
    the ``LEAST`` smallest, so that short texts can be compared as well. Sketches merge: the
    sketch of a union is the union of sketches, cut by the same rule.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    starts, ends = word_spans(data, bounds[:-1])
    hashes = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds)
    n = len(hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        rolled[: max(n - k, 0)] += hashes[k:] * _PLACES[k]
    rolled = mix64(rolled)
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if z - a >= words:
            found = np.unique(rolled[a : z - words + 1])
        elif z > a:
            found = mix64(np.array([(hashes[a:z] * _PLACES[: z - a]).sum(dtype=np.uint64)], dtype=np.uint64))
        else:
            found = rolled[:0]
        out.append(found[: max(LEAST, int(np.searchsorted(found, _LIMIT)))])
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    found = np.union1d(a, b)
    return found[: max(LEAST, int(np.searchsorted(found, _LIMIT)))]


def _reach(s: np.ndarray) -> np.uint64:
    """Up to which hash a sketch is complete."""
    if len(s) < LEAST:
        return _END
    return max(s[-1], _LIMIT) if len(s) == LEAST else _LIMIT


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Likeness (Jaccard), and how much of a is in b, and of b in a.

    Both are cut where both are complete. Two texts without words are alike; one without
    words is unlike any other.
    """
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same, same
    reach = min(_reach(a), _reach(b))
    a, b = a[: np.searchsorted(a, reach, "right")], b[: np.searchsorted(b, reach, "right")]
    both = len(np.intersect1d(a, b, assume_unique=True))
    joint = len(a) + len(b) - both
    return both / joint if joint else 0.0, both / len(a) if len(a) else 0.0, both / len(b) if len(b) else 0.0


def as_text(s: np.ndarray) -> str:
    """A sketch as 16 hex digits a hash, in rising order."""
    return s.astype(">u8").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s), dtype=">u8").astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first as many code points of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, inside_edited double, inside_next double"
)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Runs of (ids, texts, next texts) from rows sorted by bucket, guests first, ids falling.

    A bucket's guests come first: the first of them follows the bucket's last row.
    """
    bucket, follower, held = None, "", None
    ids: list = []
    texts: list[str] = []
    nexts: list[str] = []
    size = 0

    def add(row: tuple, following: str) -> None:
        ids.append(row[0])
        texts.append(row[1])
        nexts.append(following)

    for batch in batches:
        for b, guest, doc, text in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
            text = text or ""
            if b != bucket:
                if held:
                    add(held, follower)
                bucket, follower, held = b, text if guest else "", None
            if not guest:
                if held:
                    add(held, text)
                held = (doc, text)
                size += len(text)
            if size > 500_000:
                yield list(ids), list(texts), list(nexts)
                ids.clear(), texts.clear(), nexts.clear()
                size = 0
    if held:
        add(held, follower)
    if ids:
        yield ids, texts, nexts


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 65_536) -> DataFrame:
    """Sketches of every text and of its edited text, and how near they are.

    The edited text takes from the next row in falling order of ``key`` (null last; equal keys
    by their texts' hash; the first follows the last). Null texts are empty. Repeated rows are
    rows of their own; other columns are left out. near_edited and near_next are likeness,
    inside_edited and inside_next the share of the text's own shingles.

    Rows are dealt into ranges of at most about ``rows`` keys, four or more for each shuffle
    partition, cut at keys of the table, which a shuffle of the keys alone finds. The row that starts a range is sent to the range below
    too, so each row meets its next one after a single shuffle of the texts.
    """
    spark = docs.sparkSession
    keyed = docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).withColumn(
        "order", F.coalesce("doc_id", F.lit(-(2**63)))
    )
    ids = staged(keyed.select("order"), "ids")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = ids.count()
    parts = max(1, min(total, max(4 * tasks, -(-total // rows))))
    tops = ids.repartitionByRange(parts, "order").groupBy(F.spark_partition_id()).agg(F.max("order").alias("top"))
    bounds = np.array(sorted(r["top"] for r in tops.collect()), dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def place(order):
        """Twice the range's number, and one more if the key ends the range."""
        at = np.searchsorted(bounds, order.to_numpy())
        at = np.minimum(at, len(bounds) - 1)
        return (order * 0 + at * 2 + (bounds[at] == order.to_numpy())).astype("int32")

    last = max(len(bounds), 1)
    own = F.struct(F.shiftright("place", 1).alias("bucket"), F.lit(False).alias("own_guest"))
    lent = F.struct(((F.shiftright("place", 1) + 1) % last).alias("bucket"), F.lit(True).alias("own_guest"))
    dealt = (
        keyed.withColumn("place", place("order"))
        .withColumn("to", F.explode(F.when(F.col("place") % 2 == 1, F.array(own, lent)).otherwise(F.array(own))))
        .select(
            F.col("to.bucket").alias("bucket"), F.col("to.own_guest").alias("guest"), "doc_id", "text", "order",
            F.xxhash64("text").alias("tie"),
        )
    )
    sorted_rows = dealt.repartition(tasks, "bucket").sortWithinPartitions(
        "bucket", F.desc("guest"), F.desc("order"), "tie"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, nexts in _with_next(batches):
            out: list[list] = [[] for _ in range(9)]
            raw = [t.encode("utf-8") for t in texts]
            changed = [edited(t, n).encode("utf-8") for t, n in zip(texts, nexts, strict=True)]
            following = [n.encode("utf-8") for n in nexts]
            for a, z in byte_slices(raw):
                mine, after = sketches(raw[a:z]), sketches(changed[a:z])
                for i, s, e in zip(range(a, z), mine, after, strict=True):
                    here = i + 1 < z and raw[i + 1] == following[i]  # mostly the next row
                    to_edit, to_next = compare(s, e), compare(s, mine[i + 1 - a] if here else sketches([following[i]])[0])
                    row = (
                        keys[i], len(texts[i]), hashlib.sha256(changed[i]).hexdigest(), as_text(s), as_text(e),
                        to_edit[0], to_next[0], to_edit[1], to_next[1],
                    )
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
            names = [c.split()[0] for c in _SCHEMA.split(",")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return sorted_rows.mapInArrow(run, _SCHEMA)
