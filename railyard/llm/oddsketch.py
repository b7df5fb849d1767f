"""MinHash near-dedup: odd sketches verify the candidates of banded MinHash samples."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import byte_slices, mix64, staged, word_hashes, word_spans
from railyard.llm.components import components

#: Each of 32 bands holds 5 samples: texts at 0.85 miss each other in all of them with a
#: probability of (1 - 0.85 ** 5) ** 32, that is 7e-9.
BANDS, BAND_ROWS = 32, 5

SAMPLES = BANDS * BAND_ROWS

#: Bits of a parity bitmap.
SKETCH_BITS = 512

#: The chance that the bitmaps of a pair just at the threshold differ in too many bits.
MISS = 1e-7

#: Members of a band's bucket up to which they are equal-joined; those of a larger bucket
#: are compared chunk by chunk, which is exact too.
JOINED_BUCKET = 32

#: Members of a chunk, and their shingles.
CHUNK_ROWS, CHUNK_SHINGLES = 1024, 1_000_000

_PARTNERS = 24
_FILTER_BITS = 1 << 24

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALTS = mix64(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP)
_FACTORS = mix64(_SALTS + _STEP) | np.uint64(1)


def shingle_set(data: np.ndarray, words: int) -> np.ndarray:
    """The distinct hashes of a text's shingles; of fewer words, of the whole sequence.

    ``data`` are the text's bytes. Hashes have 64 bits, so two shingles of a pair of texts
    with a million words each are confused with a chance of 1e-7.
    """
    data = _LOWER[data]
    hashes = word_hashes(data, *word_spans(data, np.zeros(1, dtype=np.int64)))
    n = len(hashes)
    if not n:
        return hashes
    size = min(n, words)
    joined = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        joined = mix64(joined * _STEP + hashes[i : n - size + 1 + i])
    return np.unique(joined)


def samples(shingles: np.ndarray) -> np.ndarray:
    """The least value of a set under each of ``SAMPLES`` hash functions."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        block = (shingles[at : at + 1024] ^ _SALTS[:, None]) * _FACTORS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit name for the samples of each band."""
    name = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        name = mix64(name * _STEP + column)
    return name


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The parity bitmap of the samples: each sample flips the bit that it hashes to."""
    spots = (mix64(least + _SALTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(spots, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def estimate(differing: float) -> float:
    """The similarity that a number of differing bits speaks for."""
    share = min(2 * differing / SKETCH_BITS, 1 - 1e-9)
    return max(0.0, 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log1p(-share)))


@lru_cache(maxsize=8)
def allowed_bits(percent: int, miss: float = MISS) -> int:
    """The most bits in which the bitmaps of linked texts differ, but for a chance of ``miss``.

    A binomial number of samples differs at that similarity; each flips one bit of either
    bitmap, and the number of odd bits after every flip is followed exactly.
    """
    p = percent / 100
    odd = np.zeros(SKETCH_BITS + 1)
    odd[0] = 1.0
    places = np.arange(SKETCH_BITS + 1) / SKETCH_BITS
    total = np.zeros(SKETCH_BITS + 1)
    for differ in range(SAMPLES + 1):
        total += math.comb(SAMPLES, differ) * p ** (SAMPLES - differ) * (1 - p) ** differ * odd
        for _ in range(2):
            up, down = odd * (1 - places), odd * places
            odd = np.append(0.0, up[:-1]) + np.append(down[1:], 0.0)
    above = np.cumsum(total[::-1])[::-1]  # chance of at least so many bits
    return int(np.argmax(above <= miss)) - 1


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """key, cls, n (distinct shingles), bands and sketch of every row of (key, cls, text)."""
    kind = docs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, cls binary, n bigint, bands array<bigint>, sketch array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8") for t in batch.column(2).to_pylist()]
            for a, z in byte_slices(texts, 8_000_000):
                met: dict[bytes, tuple] = {}
                out = []
                for text in texts[a:z]:
                    if text not in met:
                        found = shingle_set(np.frombuffer(text, dtype=np.uint8), words)
                        least = samples(found) if len(found) else None
                        met[text] = (
                            len(found),
                            [] if least is None else bands(least).view(np.int64),
                            [] if least is None else odd_sketch(least).view(np.int64),
                        )
                    out.append(met[text])
                n, names, maps = zip(*out, strict=True)
                long_list = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, z - a),
                        batch.column(1).slice(a, z - a),
                        pa.array(n, pa.int64()),
                        pa.array(names, long_list),
                        pa.array(maps, long_list),
                    ],
                    ["key", "cls", "n", "bands", "sketch"],
                )

    return docs.mapInArrow(run, schema)


def _differing(a: str, b: str) -> Column:
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH_BITS // 64)))


def _alike(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow a link."""
    for side in "ab":
        about = reps.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
        pairs = pairs.join(about, side)
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return pairs.where(sizes & (_differing("s_a", "s_b") <= allowed_bits(percent))).select("a", "b")


def _spot(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(_FILTER_BITS))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the wanted representatives (id, low, wanted_cls).

    A bitmap of the wanted rows, of a fixed size, keeps most other texts out of the shuffle.
    """
    bit = _spot("low", "wanted_cls")
    bits = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("mask"))
    )
    near = docs.withColumn("bit", _spot("key", "cls")).join(
        F.broadcast(bits),
        F.expr("shiftright(bit, 6) = word AND (shiftrightunsigned(mask, CAST(bit % 64 AS INT)) & 1L) = 1"),
        "left_semi",
    )
    found = near.join(wanted, F.col("key").eqNullSafe(F.col("low")) & (F.col("cls") == F.col("wanted_cls")))
    return found.select("id", "text").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity.

    The partners of one text are dealt to groups of about ``_PARTNERS``, so each group holds
    few texts, however many partners there are.
    """
    pairs = staged(pairs, "odd-pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / _PARTNERS).alias("groups"))
    dealt = pairs.join(groups, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("part"))
    members = dealt.select("a", "part", F.col("b").alias("id"))
    members = staged(members.unionByName(dealt.select("a", "part", F.col("a").alias("id")).distinct()), "odd-members")
    wanted = members.select("id").distinct().join(reps, "id")
    wanted = staged(wanted.select("id", "low", F.col("cls").alias("wanted_cls")), "odd-wanted")

    def check(rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_pylist()
        texts = rows.column("text").to_pylist()
        hub = rows.column("a")[0].as_py()
        sets = {i: shingle_set(np.frombuffer(t.encode("utf-8"), dtype=np.uint8), words) for i, t in zip(ids, texts, strict=True)}
        own = sets.pop(hub)
        linked = []
        for i, other in sets.items():
            both = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * both >= percent * (len(own) + len(other) - both):
                linked.append(i)
        return pa.table({"a": pa.array([hub] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    rows = members.join(_texts(docs, wanted), "id")
    return staged(rows.groupBy("a", "part").applyInArrow(check, "a bigint, b bigint"), "odd-links")


def _alike_matrix(left: tuple, right: tuple, percent: int) -> np.ndarray:
    """Which pairs of two chunks (root, n, sketch) may be links between components."""
    (ra, na, sa), (rb, nb, sb) = left, right
    far = np.zeros((len(na), len(nb)), dtype=np.int64)
    for k in range(sa.shape[1]):
        far += np.bitwise_count(sa[:, k, None] ^ sb[:, k])
    near = (far <= allowed_bits(percent)) & (ra[:, None] != rb)
    return near & (100 * np.minimum(na[:, None], nb) >= percent * np.maximum(na[:, None], nb))


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many shingles each set of ``left`` has in common with each of ``right``.

    Products of 0/1 matrices over the shingles that both sides hold, some columns at a time.
    """
    values = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    shared = np.intersect1d(*(np.unique(v) for v in values), assume_unique=True)
    held = []
    for value, row in zip(values, rows, strict=True):
        at = np.searchsorted(shared, value)
        at[at == len(shared)] = 0
        known = shared[at] == value if len(shared) else np.zeros(len(value), dtype=bool)
        order = np.argsort(at[known], kind="stable")
        held.append((at[known][order], row[known][order]))
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for first in range(0, len(shared), columns):
        sides = []
        for (at, row), n in zip(held, total.shape, strict=True):
            a, z = np.searchsorted(at, [first, first + columns])
            part = np.zeros((n, columns), dtype=np.float32)
            part[row[a:z], at[a:z] - first] = 1
            sides.append(part)
        total += (sides[0] @ sides[1].T).astype(np.int64)
    return total


def _spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the same nodes as all of them, without a circle."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            above[p] = q
            out.append((x, y))
    return out


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a cell's two chunks; a chunk that meets itself is both."""
    side = rows.column("side").to_numpy()
    if (side == 0).all():
        return (np.arange(len(side)),) * 2
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def _crowd_links(crowd: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (a, b) between differently labelled members of large buckets.

    A bucket's members are dealt to chunks, and every two chunks of a bucket meet in a cell,
    as does each chunk with itself. A cell first compares bitmaps; members that agree with
    one of another label meet again in the same cell with their texts, where all pairs
    are counted exactly. No pair leaves a cell but the links that connect its members. Buckets with the
    same members are compared once. ``crowd`` has entry, id and root.
    """
    about = crowd.join(reps.select("id", "n", "sketch"), "id")
    sizes = about.groupBy("entry").agg(
        F.count("*").alias("cnt"), F.sum("n").alias("shingles"), F.bit_xor(F.xxhash64("id")).alias("sign")
    )
    sizes = sizes.groupBy("cnt", "shingles", "sign").agg(F.min("entry").alias("entry"))
    chunks = F.greatest(F.ceil(F.col("cnt") / CHUNK_ROWS), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    dealt = about.join(sizes.select("entry", chunks.alias("chunks")), "entry")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int"))
    cells = dealt.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)"))).select(
        "entry",
        F.least("chunk", "other").alias("i"),
        F.greatest("chunk", "other").alias("j"),
        F.when(F.col("chunk") <= F.col("other"), 0).otherwise(1).alias("side"),
        "id", "root", "n", "sketch",
    )

    def sift(rows: pa.Table) -> pa.Table:
        maps = rows.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(rows), -1)
        root, n = (rows.column(c).to_numpy() for c in ("root", "n"))
        left, right = _sides(rows)
        near = _alike_matrix(*((root[x], n[x], maps[x]) for x in (left, right)), percent)
        keep = np.union1d(left[near.any(axis=1)], right[near.any(axis=0)])
        return rows.drop_columns(["n"]).take(pa.array(keep))

    kinds = "entry bigint, i int, j int, side int, id bigint, root bigint, sketch array<bigint>"
    held = staged(cells.groupBy("entry", "i", "j").applyInArrow(sift, kinds), "odd-cells")
    wanted = held.select("id").distinct().join(reps, "id")
    wanted = staged(wanted.select("id", "low", F.col("cls").alias("wanted_cls")), "odd-wanted")

    def link(rows: pa.Table) -> pa.Table:
        ids, root = (rows.column(c).to_numpy() for c in ("id", "root"))
        sets = [shingle_set(np.frombuffer(t.as_py().encode("utf-8"), dtype=np.uint8), words) for t in rows.column("text")]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        left, right = _sides(rows)
        both = common_counts([sets[x] for x in left], [sets[x] for x in right])
        linked = 100 * both >= percent * (size[left][:, None] + size[right] - both)
        p, q = np.nonzero(linked & (root[left][:, None] != root[right]))
        found = _spanning(ids[left[p]], ids[right[q]])
        return pa.table({c: pa.array([x[k] for x in found], pa.int64()) for k, c in enumerate("ab")})

    rows = held.drop("sketch").join(_texts(docs, wanted), "id")
    return staged(rows.groupBy("entry", "i", "j").applyInArrow(link, "a bigint, b bigint"), "odd-links")


def _edges(reps: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Edges between representatives that connect all that are linked.

    First each bucket's members are confirmed against its least member, a star that is linear
    in the bucket. Whoever is linked to a hub gets the label of the least such hub, and that
    hub's own; so equal labels are connected. Buckets of one label are done, and in the others
    every pair with different labels is compared and confirmed.
    """
    entries = reps.select("id", F.explode("bands").alias("entry"))
    counts = entries.groupBy("entry").agg(F.count("*").alias("cnt"), F.min("id").alias("hub")).where("cnt > 1")
    crowd = staged(entries.join(counts, "entry"), "odd-entries")
    star = crowd.where("id > hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    first = confirmed(_alike(star, reps, percent), reps, docs, percent, words)
    hubs = first.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("hub"))
    above = hubs.select(F.col("node").alias("of"), F.col("hub").alias("top"))
    so_far = hubs.join(above, F.col("hub") == F.col("of"), "left")
    so_far = staged(so_far.select("node", F.coalesce("top", "hub").alias("root")), "odd-labels")
    placed = crowd.join(so_far, crowd["id"] == so_far["node"], "left").withColumn("root", F.coalesce("root", "id"))
    split = placed.groupBy("entry").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = staged(placed.drop("node").join(split.select("entry"), "entry"), "odd-rest")
    few = rest.where(F.col("cnt") <= JOINED_BUCKET)
    left = few.select("entry", "hub", F.col("id").alias("a"), F.col("root").alias("root_a"))
    right = few.select("entry", F.col("id").alias("b"), F.col("root").alias("root_b"))
    pairs = left.join(right, "entry").where("a < b AND a > hub AND root_a <> root_b").select("a", "b").distinct()
    more = confirmed(_alike(pairs, reps, percent), reps, docs, percent, words)
    many = rest.where(F.col("cnt") > JOINED_BUCKET).select("entry", "id", "root")
    if not many.isEmpty():
        more = more.unionByName(_crowd_links(many, reps, docs, percent, words))
    return first.unionByName(more)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, words: int = 5
) -> DataFrame:
    """``key``, n_shingles, component_id and kept of every row.

    Texts are linked whose sets of ``words``-word shingles have at least ``percent`` of their
    union in common; a text of fewer words is one shingle. component_id is the least key that
    links reach. Candidates share a band of MinHash samples, their bitmaps of sample parities
    (odd sketches) must agree, and links are confirmed on full sets. Equal texts are one
    representative from the start.

    A null, empty or blank text has no shingle and is linked with nothing: its component_id
    is its own key. Null keys don't count for component_id; a component of null keys has
    null. ``kept`` is null-safe equality of the two. Repeated rows repeat. Texts of any length
    are read whole. An empty table gives an empty table; other columns may have any names.
    """
    rows = docs.select(
        docs[key].alias("key"), F.unhex(F.md5(F.coalesce(docs[text], F.lit("")))).alias("cls"), docs[text].alias("text")
    )
    points = staged(sketches(rows, words), "odd-points")
    reps = points.where("n > 0").groupBy("cls").agg(
        F.min("key").alias("low"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")]
    )
    reps = staged(reps.withColumn("id", F.monotonically_increasing_id()), "odd-texts")
    roots = staged(components(_edges(reps, rows, percent, words)), "odd-components")
    named = reps.join(roots, reps["id"] == roots["node"], "left").select("cls", "low", F.coalesce("root", "id").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = staged(named.join(lowest, "root").select("cls", "component_id"), "odd-classes")
    out = points.join(classes, "cls", "left")
    component = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )
