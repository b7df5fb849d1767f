"""Phrase collocation mining with weighted acyclic automata of n-gram counts."""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import mix64, staged

#: Words of one shard automaton, and arcs of one prefix range.
SHARD_WORDS, RANGE_ARCS = 3_000_000, 3_000_000

#: A shard notes the path of every so many arcs; so many notes of all decide the ranges.
_MARK_EVERY, _MARKS = 8192, 50_000

#: Bits of the filter that holds the frequent n-grams of one order for the next. Its size is
#: fixed; a crowded filter lets more n-grams through and never loses one.
FILTER_BITS = 1 << 25

_CUT = b"\xff"
_BYTES = bytearray(range(256))
_BYTES[65:91] = range(97, 123)
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = 0xFF
_BYTES = bytes(_BYTES)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, with a cut (no UTF-8 text holds that byte) between its pieces."""
    return (text or "").encode("utf-8").translate(_BYTES).replace(_CUT, b" \xff ").split()


class Counts:
    """Weighted paths of a trie, a level of arcs after the other.

    ``words`` rise; an arc's label is a place in them. Level 0 holds languages, level k the
    k-th words. Arcs of a level are sorted by their path; ``parents`` are arcs of the level
    above. An arc with weight 0 only leads on.
    """

    def __init__(self, words: list[bytes], parents: list, labels: list, weights: list):
        self.words, self.parents, self.labels, self.weights = words, parents, labels, weights

    @classmethod
    def of_levels(cls, words: list[bytes], levels: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray | int]]) -> Counts:
        """From (parent, label, weight) of arcs in any order; equal arcs are summed.

        Parents are places in the level above as it was given; a weight may be one for all.
        """
        parents, labels, weights, moved, above = [], [], [], np.zeros(1, dtype=np.int64), 1
        width = max(len(words), 1)
        for k, (parent, label, weight) in enumerate(levels):
            keys = moved[parent] * width + label
            inverse = k + 1 < len(levels) or not isinstance(weight, int)
            if above * width <= 4 * len(keys):  # few possible arcs: counted, not sorted
                times = np.bincount(keys, minlength=above * width)
                arcs = np.flatnonzero(times)
                times, moved = times[arcs], (np.cumsum(times > 0) - 1)[keys] if inverse else None
            elif inverse:
                arcs, moved, times = np.unique(keys, return_inverse=True, return_counts=True)
            else:
                arcs, times = np.unique(keys, return_counts=True)
            if isinstance(weight, int):
                total = times.astype(np.int64) * weight
            else:
                total = np.zeros(len(arcs), dtype=np.int64)
                np.add.at(total, moved, weight)
            parents.append(arcs // width)
            labels.append(arcs % width)
            weights.append(total)
            above = len(arcs)
        return cls(words, parents, labels, weights)

    @classmethod
    def union(cls, parts: Sequence[Counts]) -> Counts:
        """All paths of several, weights summed."""
        words = sorted(set().union(*(p.words for p in parts)))
        number = {w: i for i, w in enumerate(words)}
        depth = max((len(p.labels) for p in parts), default=0)
        moved = [np.array([number[w] for w in p.words], dtype=np.int64) for p in parts]
        levels, base = [], [0] * len(parts)
        for k in range(depth):
            deep = [i for i, p in enumerate(parts) if len(p.labels) > k]
            levels.append(
                (
                    np.concatenate([parts[i].parents[k] + base[i] for i in deep]),
                    np.concatenate([moved[i][parts[i].labels[k]] for i in deep]),
                    np.concatenate([parts[i].weights[k] for i in deep]),
                )
            )
            ends = np.cumsum([len(p.labels[k]) if len(p.labels) > k else 0 for p in parts])
            base = [0, *ends[:-1].tolist()]
        return cls.of_levels(words, levels)

    def arcs(self) -> int:
        return sum(map(len, self.labels))

    def path(self, level: int, arc: int) -> tuple[bytes, ...]:
        out = []
        for k in range(level, -1, -1):
            out.append(self.words[self.labels[k][arc]])
            arc = self.parents[k][arc]
        return tuple(reversed(out))

    def _preorder(self) -> list[np.ndarray]:
        """Each arc's place when every arc is followed by those below it."""
        below = [np.ones(len(x), dtype=np.int64) for x in self.labels]
        for k in range(len(below) - 1, 0, -1):
            np.add.at(below[k - 1], self.parents[k], below[k])
        place = []
        for k, size in enumerate(below):
            before = np.cumsum(size) - size
            if k:
                first = np.searchsorted(self.parents[k], self.parents[k])
                before = before - before[first] + place[-1][self.parents[k]] + 1
            place.append(before)
        return place

    def marks(self, every: int) -> list[tuple[bytes, ...]]:
        """The path of every so many-th arc in path order."""
        out = []
        for k, place in enumerate(self._preorder()):
            out += [self.path(k, a) for a in np.flatnonzero(place % every == every - 1).tolist()]
        return sorted(out)

    def cut(self, bounds: list[tuple[bytes, ...]]) -> Iterator[tuple[int, Counts]]:
        """(i, the paths from bounds[i - 1] on and below bounds[i]), where there are some.

        A range is one slice of every level; the arcs above its first path come along with
        weight 0.
        """
        place = self._preorder()
        total, depth = self.arcs(), len(self.labels)
        level_of, arc_of = np.zeros(total, dtype=np.int8), np.zeros(total, dtype=np.int64)
        for k, p in enumerate(place):
            level_of[p], arc_of[p] = k, np.arange(len(p))
        cuts = [0]
        for bound in bounds:
            low, high = cuts[-1], total
            while low < high:
                mid = (low + high) // 2
                if self.path(int(level_of[mid]), int(arc_of[mid])) < bound:
                    low = mid + 1
                else:
                    high = mid
            cuts.append(low)
        cuts.append(total)
        for i in range(len(cuts) - 1):
            if cuts[i] == cuts[i + 1]:
                continue
            own = [np.searchsorted(p, cuts[i : i + 2]) for p in place]
            first = [int(a) for a, _ in own]
            for k in range(depth - 1, 0, -1):
                if first[k] < own[k][1]:
                    first[k - 1] = min(first[k - 1], int(self.parents[k][first[k]]))
            levels = []
            for k in range(depth):
                a, z = first[k], int(own[k][1])
                weight = self.weights[k][a:z].copy()
                weight[: int(own[k][0]) - a] = 0
                parent = self.parents[k][a:z] - (first[k - 1] if k else 0)
                levels.append((parent, self.labels[k][a:z], weight))
            used = np.unique(np.concatenate([x[1] for x in levels]))
            yield (
                i,
                Counts(
                    [self.words[w] for w in used.tolist()],
                    [x[0] for x in levels],
                    [np.searchsorted(used, x[1]) for x in levels],
                    [x[2] for x in levels],
                ),
            )

    def at_least(self, least: int) -> Counts:
        """The paths with that weight, and the arcs that lead to them."""
        keep = [w >= least for w in self.weights]
        for k in range(len(keep) - 1, 0, -1):
            keep[k - 1][self.parents[k][keep[k]]] = True
        parents, labels, weights = [], [], []
        for k, held in enumerate(keep):
            moved = np.cumsum(keep[k - 1]) - 1 if k else np.zeros(1, dtype=np.int64)
            parents.append(moved[self.parents[k][held]])
            labels.append(self.labels[k][held])
            weights.append(np.where(self.weights[k] >= least, self.weights[k], 0)[held])
        used = np.unique(np.concatenate(labels)) if labels else np.zeros(0, dtype=np.int64)
        return Counts([self.words[w] for w in used.tolist()], parents, [np.searchsorted(used, x) for x in labels], weights)

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(level, labels of each path, weight) of the paths that end on a level."""
        paths = np.zeros((1, 0), dtype=np.int64)
        for k, label in enumerate(self.labels):
            paths = np.column_stack([paths[self.parents[k]], label])
            held = self.weights[k] > 0
            yield k, paths[held], self.weights[k][held]


class Automaton:
    """``Counts`` with equal states stored once, from the last level to the first.

    A state is its arcs: label, weight and target state. States of a level are equal if all
    their arcs are, so n-grams share their ends as well as their beginnings.
    """

    def __init__(self, words: list[bytes], first: list, labels: list, weights: list, targets: list):
        self.words, self.first, self.labels, self.weights, self.targets = words, first, labels, weights, targets

    @classmethod
    def of(cls, counts: Counts) -> Automaton:
        depth = len(counts.labels)
        first, labels, weights, targets = [], [], [], []
        target = np.zeros(len(counts.labels[-1]) if depth else 0, dtype=np.int64)
        for k in range(depth - 1, -1, -1):
            states = len(counts.labels[k - 1]) if k else 1
            start = np.searchsorted(counts.parents[k], np.arange(states + 1))
            label, weight = counts.labels[k], counts.weights[k]
            pick, moved = cls._distinct(start, label, weight, target)
            size = start[pick + 1] - start[pick]
            ends = np.cumsum(size)
            spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[pick] - (ends - size), size)
            first.append(np.concatenate(([0], ends)))
            labels.append(label[spots])
            weights.append(weight[spots])
            targets.append(target[spots])
            target = moved
        return cls(counts.words, first[::-1], labels[::-1], weights[::-1], targets[::-1])

    @staticmethod
    def _distinct(start: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One of each set of equal states, and for every state which of them it is.

        States are equal if both 64-bit names of their arcs are.
        """
        place = np.arange(len(label)) - np.repeat(start[:-1], np.diff(start))
        names = []
        for seed in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95):
            code = np.full(len(label), seed, dtype=np.uint64)
            for part in (place, label, weight, target):
                code = mix64(code * np.uint64(seed) + part.astype(np.uint64))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code, dtype=np.uint64)))
            names.append(sums[start[1:]] - sums[start[:-1]])
        _, pick, moved = np.unique(names[0], return_index=True, return_inverse=True)
        if (names[1][pick][moved] != names[1]).any():
            _, pick, moved = np.unique(np.stack(names, axis=1), axis=0, return_index=True, return_inverse=True)
        return pick, moved.reshape(-1)

    def counts(self) -> Counts:
        """The trie again: every path of its own."""
        parents, labels, weights, state = [], [], [], np.zeros(1, dtype=np.int64)
        for first, label, weight, target in zip(self.first, self.labels, self.weights, self.targets, strict=True):
            size = first[state + 1] - first[state] if len(first) > 1 else np.zeros(len(state), dtype=np.int64)
            ends = np.cumsum(size)
            spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[state] - (ends - size), size)
            parents.append(np.repeat(np.arange(len(state)), size))
            labels.append(label[spots])
            weights.append(weight[spots])
            state = target[spots]
        return Counts(self.words, parents, labels, weights)

    def compose(self, paths: list[tuple[bytes, ...]]) -> np.ndarray:
        """The weights of paths of one length: an acceptor of them, composed with this.

        All paths take their next arc together; 0 for a path that isn't there.
        """
        number = {w: i for i, w in enumerate(self.words)}
        asked = np.array([[number.get(w, -1) for w in p] for p in paths], dtype=np.int64).reshape(len(paths), -1)
        state = np.zeros(len(paths), dtype=np.int64)
        weight = np.zeros(len(paths), dtype=np.int64)
        alive = (asked >= 0).all(axis=1) & (asked.shape[1] <= len(self.labels))
        for k in range(min(asked.shape[1], len(self.labels))):
            owner = np.repeat(np.arange(len(self.first[k]) - 1), np.diff(self.first[k]))
            keys = owner << 32 | self.labels[k]
            want = state << 32 | np.maximum(asked[:, k], 0)
            at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
            alive &= (keys[at] == want) if len(keys) else False
            at = np.where(alive, at, 0)
            weight = np.where(alive, self.weights[k][at], 0) if len(keys) else weight * 0
            state = np.where(alive, self.targets[k][at], 0) if len(keys) else state
        return weight

    def pack(self) -> bytes:
        """All arrays as one compressed value."""
        parts = [_CUT.join(self.words)]
        head = [len(self.words), len(parts[0]), len(self.labels)]
        for arrays in zip(self.first, self.labels, self.weights, self.targets, strict=True):
            for a in arrays:
                small = a.astype(np.min_scalar_type(int(a.max(initial=0))))
                head += [small.itemsize, len(small)]
                parts.append(small.tobytes())
        raw = np.array([len(head), *head], dtype="<i8").tobytes() + b"".join(parts)
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @classmethod
    def unpack(cls, blob: bytes) -> Automaton:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        count, size, depth, *head = np.frombuffer(raw, "<i8", n, 8).tolist()
        at = 8 + 8 * n
        words = raw[at : at + size].split(_CUT) if count else []
        at += size
        arrays = []
        for i in range(0, 8 * depth, 2):
            width, length = head[i : i + 2]
            arrays.append(np.frombuffer(raw, f"<u{width}", length, at).astype(np.int64))
            at += width * length
        return cls(words, *(arrays[i::4] for i in range(4)))


def _word_codes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], dtype=np.uint64)


def _pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _pack_numbers(a: np.ndarray) -> bytes:
    """Small numbers, compressed byte place by byte place."""
    planes = a.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack_numbers(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


class Shard:
    """The words of many texts as numbers: 0 is a cut, others are places in ``words``, plus 1.

    ``words`` rise; ``langs`` and ``sizes`` have the language and length of each text.
    """

    def __init__(self, words: list[bytes], ids: np.ndarray, langs: list[bytes], sizes: list[int]):
        self.words, self.ids, self.langs, self.sizes = words, ids, langs, sizes

    def pack(self) -> tuple[bytes, bytes, list[str], list[int]]:
        return (
            zstandard.ZstdCompressor(level=3).compress(_CUT.join(self.words)),
            _pack_numbers(self.ids),
            [x.decode("utf-8") for x in self.langs],
            self.sizes,
        )

    @classmethod
    def unpack(cls, words: bytes, ids: bytes, langs: list[str], sizes: list[int]) -> Shard:
        found = zstandard.ZstdDecompressor().decompress(words)
        return cls(found.split(_CUT) if found else [], _unpack_numbers(ids), [x.encode("utf-8") for x in langs], sizes)

    def totals(self) -> dict[str, int]:
        """The number of words of each language."""
        first = np.cumsum([0, *self.sizes[:-1]])
        out: dict[str, int] = {}
        for lang, n in zip(self.langs, np.add.reduceat(self.ids > 0, first, dtype=np.int64).tolist(), strict=True):
            out[lang.decode("utf-8")] = out.get(lang.decode("utf-8"), 0) + n
        return out

    def counts(self, low: int, high: int, bits: np.ndarray | None) -> Counts:
        """The counts of n-grams of ``low`` to ``high`` words.

        An n-gram is counted if all its parts of ``low`` - 1 words pass the filter ``bits``.
        """
        every = sorted({*self.words, *self.langs})
        place = {w: i for i, w in enumerate(every)}
        moved = np.arange(len(self.words))
        for extra in sorted({*self.langs} - {*self.words}):
            moved += moved >= place[extra]
        label = np.concatenate(([-1], moved))[self.ids]
        lang = np.repeat([place[x] for x in self.langs], self.sizes)
        # good[i]: the part of low - 1 words from i on may be frequent.
        good = self.ids > 0
        if low > 1:
            codes = np.concatenate((np.zeros(1, np.uint64), _word_codes(self.words)))
            if low == 2:
                good &= _passes(codes, bits)[self.ids]
            else:
                pair = np.flatnonzero(good[:-1] & good[1:])
                good = np.zeros(len(good), dtype=bool)
                good[pair] = _passes(_pair_codes(codes[self.ids[pair]], codes[self.ids[pair + 1]]), bits)
        starts, valid = {}, good  # order -> first words of its n-grams
        for order in range(max(low - 1, 1), high + 1):
            if order >= low:
                starts[order] = np.flatnonzero(valid)
            # An n-gram may be frequent if the two that it holds, one word shorter, may.
            valid = valid & np.append(valid[1:], False)
        spots = starts[low]
        levels = [(np.zeros(len(spots), dtype=np.int64), lang[spots], 0)]
        for depth in range(1, high + 1):
            # Arcs of a level stand in the order of the n-grams that made them.
            if depth > low:
                parent = np.flatnonzero(np.isin(spots, starts[depth], assume_unique=True))
                spots = spots[parent]
            else:
                parent = np.arange(len(spots))
            levels.append((parent, label[spots + depth - 1], int(depth >= low)))
        return Counts.of_levels(every, levels)


def _passes(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    spot = codes % np.uint64(64 * len(bits))
    return (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def encode_shards(texts: Iterator[tuple[str, str | None]], size: int) -> Iterator[Shard]:
    """Texts (lang, text) gathered to shards of about ``size`` words and cuts."""
    number: dict[bytes, int] = defaultdict()
    held: list[np.ndarray] = []
    langs: list[bytes] = []
    total = 0

    def shard() -> Shard:
        words = sorted(number.keys() - {_CUT})
        moved = np.empty(len(number), dtype=np.int64)
        moved[0] = 0
        moved[[number[w] for w in words]] = np.arange(1, len(words) + 1)
        return Shard(words, moved[np.concatenate(held)], langs, [len(x) for x in held])

    for lang, text in texts:
        if not total:
            number = defaultdict()
            number.default_factory = number.__len__
            number[_CUT]
            held, langs = [], []
        found = words_of(text)
        found.append(_CUT)
        held.append(np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found)))
        langs.append(lang.encode("utf-8"))
        total += len(found)
        if total >= size:
            yield shard()
            total = 0
    if total:
        yield shard()


def _first_pass(docs: DataFrame) -> DataFrame:
    """One row for each shard: its words and numbers, and the automaton of its word counts."""
    size = SHARD_WORDS

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                yield lang.as_py(), text.as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in encode_shards(texts(batches), size):
            packed = shard.pack()
            kinds = (pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))
            columns = [pa.array([v], k) for v, k in zip(packed, kinds, strict=True)]
            counted = _counted_row(shard.counts(1, 1, None))
            totals = shard.totals()
            columns += [pa.array([list(totals)], kinds[2]), pa.array([list(totals.values())], kinds[3])]
            yield pa.RecordBatch.from_arrays([*columns, *counted], [*names, *_COUNTED])

    names = ["words", "ids", "langs", "sizes", "total_langs", "totals"]
    schema = (
        "words binary, ids binary, langs array<string>, sizes array<bigint>,"
        f" total_langs array<string>, totals array<bigint>, {_COUNTED_SCHEMA}"
    )
    return docs.mapInArrow(run, schema)


_COUNTED = ["blob", "arcs", "marks"]
_COUNTED_SCHEMA = "blob binary, arcs bigint, marks array<binary>"


def _counted_row(counts: Counts) -> list[pa.Array]:
    marks = [_CUT.join(m) for m in counts.marks(_MARK_EVERY)]
    return [
        pa.array([Automaton.of(counts).pack()], pa.binary()),
        pa.array([counts.arcs()], pa.int64()),
        pa.array([marks], pa.list_(pa.binary())),
    ]


def _later_pass(shards: DataFrame, low: int, high: int, bits: np.ndarray) -> DataFrame:
    """One automaton row for each shard: the counts of its n-grams that pass the filter."""
    shared = shards.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Shard.unpack(*row).counts(low, high, shared.value)
                yield pa.RecordBatch.from_arrays(_counted_row(counts), _COUNTED)

    return shards.select("words", "ids", "langs", "sizes").mapInArrow(run, _COUNTED_SCHEMA)


def _bounds(shards: DataFrame) -> list[tuple[bytes, ...]]:
    """Paths that cut all shards' automata into ranges of about ``RANGE_ARCS``.

    A bounded number of marks comes to the driver. They decide where ranges are cut, not what
    is counted.
    """
    arcs = shards.agg(F.sum("arcs")).first()[0] or 0
    marks = shards.select(F.explode("marks").alias("m")).orderBy(F.rand(1)).limit(_MARKS)
    found = sorted(tuple(bytes(r["m"]).split(_CUT)) for r in marks.collect())
    ranges = min(-(-arcs // RANGE_ARCS), 20_000)
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def _united(shards: DataFrame, bounds: list[tuple[bytes, ...]], least: int, label: str) -> DataFrame:
    """(range, blob): the union of all shards within each prefix range, frequent paths only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                for i, part in Automaton.unpack(blob.as_py()).counts().cut(bounds):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([Automaton.of(part).pack()], pa.binary())], ["range", "blob"]
                    )

    def unite(rows: pa.Table) -> pa.Table:
        parts = [Automaton.unpack(b.as_py()).counts() for b in rows.column("blob")]
        whole = Counts.union(parts).at_least(least)
        return pa.table({"range": rows.column("range").slice(0, 1), "blob": pa.array([Automaton.of(whole).pack()], pa.binary())})

    parts = shards.select("blob").mapInArrow(cut, "range int, blob binary")
    return staged(parts.groupBy("range").applyInArrow(unite, "range int, blob binary"), label)


def _filter(united: DataFrame, order: int) -> np.ndarray:
    """The filter of the frequent n-grams of ``order`` (1 or 2) words, whatever language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                counts = Automaton.unpack(blob.as_py()).counts()
                codes = _word_codes(counts.words)
                for level, paths, _ in counts.rows():
                    if level == order:
                        code = codes[paths[:, 1]] if order == 1 else _pair_codes(codes[paths[:, 1]], codes[paths[:, 2]])
                        spot = np.unique(code % np.uint64(FILTER_BITS))
                        yield pa.RecordBatch.from_arrays([pa.array(spot.astype(np.int64))], ["spot"])

    spots = united.select("blob").mapInArrow(run, "spot bigint")
    words = spots.groupBy(F.shiftright("spot", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(spot % 64 AS INT)))").alias("mask")
    )
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    got = words.toArrow()
    bits[got.column("at").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return bits


def _frequent(united: DataFrame) -> DataFrame:
    """(lang, phrase, k, f) of every n-gram in the united automata; k counts its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                counts = Automaton.unpack(blob.as_py()).counts()
                words = [w.decode("utf-8") for w in counts.words]
                for level, paths, weights in counts.rows():
                    if level and len(paths):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([words[p[0]] for p in paths.tolist()]),
                                pa.array([" ".join([words[w] for w in p[1:]]) for p in paths.tolist()]),
                                pa.array(np.full(len(paths), level, dtype=np.int32)),
                                pa.array(weights),
                            ],
                            ["lang", "phrase", "k", "f"],
                        )

    return united.select("blob").mapInArrow(run, "lang string, phrase string, k int, f bigint")


def _looked_up(united: list[DataFrame], bounds: list[list[tuple[bytes, ...]]], parts: DataFrame) -> DataFrame:
    """(lang, part, f) of the distinct ``parts`` (lang, part, k).

    A part goes to the prefix range that may hold it, where the acceptor of all parts is
    composed with the range's automaton.
    """
    spark = parts.sparkSession
    shared = spark.sparkContext.broadcast(bounds)
    whole = None
    for i, u in enumerate(united):
        u = u.select(F.lit(i).alias("pass"), "range", "blob")
        whole = u if whole is None else whole.unionByName(u)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            step, at = [], []
            for lang, part, k in rows:
                step.append(min(k, 3) - 1)
                path = (lang.encode("utf-8"), *part.encode("utf-8").split(b" "))
                at.append(bisect_right(shared.value[step[-1]], path))
            yield pa.RecordBatch.from_arrays(
                [pa.array(step, pa.int32()), pa.array(at, pa.int32()), *batch.columns], ["pass", "range", "lang", "part", "k"]
            )

    def compose(automata: pa.Table, asked: pa.Table) -> pa.Table:
        langs, parts, sizes = (asked.column(c).to_pylist() for c in ("lang", "part", "k"))
        found = np.zeros(len(langs), dtype=np.int64)
        for blob in automata.column("blob"):
            automaton = Automaton.unpack(blob.as_py())
            for k in set(sizes):
                spots = [i for i, size in enumerate(sizes) if size == k]
                paths = [(langs[i].encode("utf-8"), *parts[i].encode("utf-8").split(b" ")) for i in spots]
                found[spots] += automaton.compose(paths)
        return pa.table({"lang": pa.array(langs, pa.string()), "part": pa.array(parts, pa.string()), "f": pa.array(found)})

    routed = parts.select("lang", "part", "k").mapInArrow(route, "pass int, range int, lang string, part string, k int")
    met = whole.groupBy("pass", "range").cogroup(routed.groupBy("pass", "range"))
    return met.applyInArrow(compose, "lang string, part string, f bigint")


def _words(phrase: str, first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def collocations(
    docs: DataFrame,
    top: int = 2000,
    least: int = 30,
    longest: int = 4,
    cover: int = 80,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases.

    A phrase has 2 to ``longest`` words (4 at most) and a = f(phrase) >= ``least``; its score
    is the lowest floor(2000000 * a / (l + r)) over its cuts (ties: the first cut), l and r
    being the counts of the two parts and n all words of the language. A phrase inside a
    longer one with 100 * f(longer) >= ``cover`` * a is dropped. Best score first, then
    larger a, then the phrase in UTF-8 byte order.

    Counting goes by words, pairs, then longer n-grams: each pass builds an automaton of
    counts for each shard, cuts it into prefix ranges and sums these over the shards. A part
    of a frequent n-gram is as frequent, so a pass leaves out n-grams with a rarer part,
    which a filter of fixed size tells; counts and totals are over all documents.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count
    each. Texts are read whole at any length. An empty table gives an empty table; other
    columns may have any names.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    rows = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].alias("text"))
    shards = staged(_first_pass(rows), "ngram-shards")
    sizes = shards.select(F.explode(F.arrays_zip("total_langs", "totals")).alias("x"))
    sizes = sizes.groupBy(F.col("x.total_langs").alias("lang_n")).agg(F.sum("x.totals").alias("n"))
    bounds = [_bounds(shards)]
    united = [_united(shards, bounds[0], least, "word-counts")]
    for low, high in ((2, 2), (3, longest))[: 1 if longest == 2 else 2]:
        counted = staged(_later_pass(shards, low, high, _filter(united[-1], low - 1)), f"ngrams-{low}")
        bounds.append(_bounds(counted))
        united.append(_united(counted, bounds[-1], least, f"ngram-counts-{low}"))
    found = _frequent(united[1])
    if longest > 2:
        found = found.unionByName(_frequent(united[2]))
    found = staged(found, "phrases")

    spans = F.expr("flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> struct(i AS i, s AS s))))")
    inner = found.where("k > 2").select("lang", "phrase", "f", F.explode(spans).alias("x"))
    longer = inner.groupBy(F.col("lang").alias("in_lang"), _words("phrase", F.col("x.i"), F.col("x.s")).alias("inner")).agg(
        F.max("f").alias("longer")
    )
    exact = "decimal(38,0)"
    open_ = found.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left").where(
        F.col("longer").isNull() | (F.col("longer").cast(exact) * 100 < F.col("f").cast(exact) * cover)
    )
    cuts = staged(
        open_.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
            "lang", "phrase", "a", "cut", "k",
            _words("phrase", F.lit(1), F.col("cut")).alias("head"),
            _words("phrase", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
        ),
        "phrase-cuts",
    )
    parts = cuts.select("lang", F.col("head").alias("part"), F.col("cut").alias("k"))
    parts = parts.unionByName(cuts.select("lang", F.col("rest").alias("part"), (F.col("k") - F.col("cut")).alias("k")))
    known = staged(_looked_up(united, bounds, parts.distinct()), "phrase-parts")
    head = known.select(F.col("lang").alias("head_lang"), F.col("part").alias("head_part"), F.col("f").alias("l"))
    rest = known.select(F.col("lang").alias("rest_lang"), F.col("part").alias("rest_part"), F.col("f").alias("r"))
    scored = cuts.join(head, F.expr("lang = head_lang AND head = head_part")).join(
        rest, F.expr("lang = rest_lang AND rest = rest_part")
    )
    value = F.expr(f"CAST((CAST(2000000 AS {exact}) * a) div (CAST(l AS {exact}) + r) AS BIGINT)")
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct(value.alias("score"), "cut", "l", "r", "a")).alias("x"))
    best = best.select("lang", "phrase", "x.*")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(sizes, F.col("lang") == F.col("lang_n")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
