"""SimHash near-duplicates by segments with one wildcard bit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import free_name, staged
from railyard.llm.components import components

#: Rows of one index entry up to which they are joined with each other; the members of a
#: larger entry are linked by ``_by_flips``, which is exact too and never pairs them.
JOINED_ENTRY = 32


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """The 64-bit SimHash of a text, as an unsigned number; 0 for a text without words."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(found) > words:
        starts, ends = starts[: 1 - words] if words > 1 else starts, ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:z], seed) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)],
        dtype="<u8",
        count=len(starts),
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, fp) of every row; fp is the fingerprint as a signed 64-bit number."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            fp = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["key", "fp"])

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind}, fp bigint")


def _variants(fps: DataFrame) -> DataFrame:
    """(entry, fp): both 32-bit halves of every fingerprint, each with every one bit wiped out.

    An entry packs the wiped bit's place (0 to 63) and the other bits of its half.
    """
    half = "(shiftrightunsigned(fp, bit - bit % 32) & 4294967295L)"
    wiped = f"({half} & ~shiftleft(1L, bit % 32))"
    return fps.select("fp", F.expr("explode(sequence(0, 63)) AS bit")).select(
        F.expr(f"{wiped} | shiftleft(CAST(bit AS BIGINT), 32)").alias("entry"), "fp"
    )


def _by_flips(fps: DataFrame) -> DataFrame:
    """Edges that connect all fingerprints at 2 or fewer bits, without pairing them.

    Each fingerprint goes to itself and to the 64 values at one bit. Two fingerprints are
    within two bits exactly if they meet at some value, and no value is met by more than 65,
    so each value's least fingerprint is linked to the others.
    """
    met = fps.select("fp", F.expr("explode(sequence(-1, 63)) AS bit")).select(
        "fp", F.expr("IF(bit < 0, fp, fp ^ shiftleft(1L, bit))").alias("value")
    )
    hub = met.groupBy("value").agg(F.min("fp").alias("hub"), F.max("fp").alias("top")).where("hub < top")
    linked = met.join(hub.select("value", "hub"), "value").where("fp > hub")
    return linked.select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all at 2 or fewer bits.

    Of two halves one differs by at most one bit then; so both fingerprints have an entry in
    common, the one where that bit is wiped out. Entries are equal-joined and each pair is
    verified on all 64 bits; a pair with equal halves counts at the first bit only. The
    members of an entry with more than ``JOINED_ENTRY`` go to ``_by_flips``.
    """
    placed = _variants(fps).repartition("entry")
    counts = placed.groupBy("entry").agg(F.count("*").alias("n")).where("n > 1")
    rows = staged(placed.join(counts.hint("shuffle_hash"), "entry").select("entry", "fp", "n"), "simhash-entries")
    few = rows.where(F.col("n") <= JOINED_ENTRY)
    left = few.select("entry", F.col("fp").alias("a"))
    right = few.select(F.col("entry").alias("other"), F.col("fp").alias("b"))
    place = "CAST(shiftright(entry, 32) AS INT)"
    pairs = left.join(
        right,
        F.expr(
            f"entry = other AND a > b AND bit_count(a ^ b) <= 2"
            f" AND ({place} % 32 = 0 OR (shiftrightunsigned(a ^ b, {place}) & 1L) = 1)"
        ),
    ).select("a", "b")
    crowd = rows.where(F.col("n") > JOINED_ENTRY).select("fp").distinct()
    return pairs.unionByName(_by_flips(crowd)).distinct()


def _classes(points: DataFrame) -> DataFrame:
    """(fp, root): the class of every distinct fingerprint."""
    fps = points.select("fp").distinct()
    linked = components(links(fps))
    return fps.join(linked, fps["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """``key``, fingerprint (16 hex digits) and component_id of every row.

    Rows whose fingerprints differ in 2 or fewer bits are linked; component_id is the least
    key that links reach (null keys don't count; a component of null keys has null). Null,
    empty and blank texts have fingerprint zero and are linked like others. Repeated rows
    repeat. Copies meet in one fingerprint before anything is paired.
    """
    points = staged(fingerprints(docs, key, text, words), "fingerprints")
    classes = staged(_classes(points), "classes")
    lowest = points.groupBy("fp").agg(F.min("key").alias("low")).join(classes, "fp")
    lowest = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lowest, "root").select("fp", "component_id")
    return points.join(named, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates: that with the least key.

    Null keys come last; equal keys are told apart by their texts' hash, and of rows that
    agree in key and text one stays. All columns stay, whatever their names.
    """
    digest = free_name(docs, "digest")
    marked = docs.withColumn(digest, F.xxhash64(docs[text]))
    pair = F.struct(marked[key].alias("key"), marked[digest].alias("digest"))
    points = staged(fingerprints(marked.select(pair.alias("key"), marked[text].alias("text")), "key", "text", words), "fingerprints")
    classes = staged(_classes(points), "classes")
    order = F.struct(F.col("key.key").isNull().alias("none"), F.col("key.key").alias("key"), F.col("key.digest").alias("digest"))
    best = points.groupBy("fp").agg(F.min(order).alias("best")).join(classes, "fp")
    of_key, of_digest, of_copies = (free_name(docs, n) for n in ("kept", "kept_digest", "copies"))
    best = best.groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.key").alias(of_key), F.col("best.digest").alias(of_digest)
    )
    copies = points.groupBy(F.col("key.key").alias("k"), F.col("key.digest").alias("d")).agg(F.count("*").alias(of_copies))
    best = best.join(copies, best[of_key].eqNullSafe(copies["k"]) & (best[of_digest] == copies["d"]))
    kept = marked.join(
        best.select(of_key, of_digest, of_copies).hint("shuffle_hash"),
        marked[key].eqNullSafe(best[of_key]) & (marked[digest] == best[of_digest]),
    )
    single = kept.where(F.col(of_copies) == 1).select(*[marked[c] for c in docs.columns])
    repeated = kept.where(F.col(of_copies) > 1).dropDuplicates([of_key, of_digest])
    return single.unionByName(repeated.select(*[marked[c] for c in docs.columns]))
