"""BPE encoding and decoding by batched merge rounds over flat symbol arrays."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from railyard.llm.common import byte_slices

#: The word pattern of the vocabulary file's pre-tokenizer; white space is
#: named by its Unicode property, as the file's library reads it.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
)

#: Words of more bytes are merged apart from the short ones.
LONG_WORD = 256


class _NewerText:
    """Texts with characters that Python's Unicode tables don't have yet.

    The vocabulary's library has tables of its own; for these few texts it lower-cases and
    splits, so that a letter of a later Unicode version is what it takes it for.
    """

    def __init__(self, pattern: str):
        self.pattern, self.assigned, self.tools = pattern, set(), None

    def concerns(self, text: str) -> bool:
        fresh = set(text) - self.assigned
        new = {c for c in fresh if unicodedata.category(c) == "Cn"}
        self.assigned |= fresh - new
        return bool(new)

    def words(self, text: str) -> list[str]:
        if not self.tools:
            from tokenizers import Regex, normalizers, pre_tokenizers

            normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
            self.tools = normal, pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        normal, split = self.tools
        return [w for w, _ in split.pre_tokenize_str(normal.normalize_str(text))]


_GAPS = regex.compile(r"\p{White_Space}+")
_ODD_GAPS = regex.compile(r"[\x1c-\x1f]")

#: Chunks whose ids a worker keeps between batches; beyond that the half that is used most stays.
CACHED_CHUNKS = 120_000

#: Rows whose texts a worker holds as Python strings, and bytes of text that it encodes at once.
BATCH_ROWS, SLICE_BYTES = 500, 1_000_000

_NONE = np.iinfo(np.int64).max


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _gather(
    flat: np.ndarray, bounds: np.ndarray, picks: list[int], groups: list[list]
) -> tuple[np.ndarray, np.ndarray]:
    """The picked slices of ``flat`` end to end, and where each group of picks ends."""
    at = np.array(picks, dtype=np.int64)
    sizes = bounds[at + 1] - bounds[at]
    total = np.concatenate(([0], np.cumsum(sizes)))
    spots = np.arange(total[-1]) + np.repeat(bounds[at] - total[:-1], sizes)
    return flat[spots], total[np.cumsum([len(g) for g in groups], dtype=np.int64)]


class Bpe:
    """A vocabulary file with word ends, as arrays that can be searched in bulk."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")"
        )
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
        self.width = len(self.names)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.newer = _NewerText(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # A token takes up no more symbols than this, and is made before it is merged on.
        self.reach = max(len(t.removesuffix(suffix)) for t in vocab)
        born = {}
        for rank, (a, b) in enumerate(pairs):
            born.setdefault(a + b, rank)
        self.rising = all(born.get(a, -1) < rank and born.get(b, -1) < rank for rank, (a, b) in enumerate(pairs))
        self._forget()

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of many words at once; the few long ones have rounds of their own."""
        raw = [w.encode("utf-8") for w in words]
        long = [i for i, r in enumerate(raw) if len(r) > LONG_WORD]
        short = [i for i, r in enumerate(raw) if len(r) <= LONG_WORD]
        done: list[np.ndarray | None] = [None] * len(words)
        for picks, local in ((short, False), (long, self.rising)):
            if picks:
                for i, ids in zip(picks, self._merge([raw[i] for i in picks], local), strict=True):
                    done[i] = ids
        return done

    def _merge(self, raw: list[bytes], local: bool) -> list[np.ndarray]:
        """Merge rounds over one flat array of the symbols of all words.

        Each round looks every neighbouring pair up by binary search, finds each word's
        lowest rank, and merges that pair wherever it stands in the word. A word leaves when
        none of its pairs can merge. With ``local`` the pairs that ``_lowest_around`` finds
        are merged in the same round, so a long word takes some hundred rounds at most, not one for
        every rank that occurs in it.
        """
        size = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(size)
        symbols[ends - 1] = self.final[data[ends - 1]]
        word = np.repeat(np.arange(len(raw)), size)
        done: list[np.ndarray | None] = [None] * len(raw)
        while len(symbols):
            same = word[1:] == word[:-1]
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = same & (self.keys[at] == key)
            rank = np.full(len(symbols), _NONE)
            rank[:-1][found] = self.ranks[at[found]]
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            if (least == _NONE).any():
                for s, n, w in zip(
                    starts[least == _NONE].tolist(),
                    counts[least == _NONE].tolist(),
                    word[starts[least == _NONE]].tolist(),
                    strict=True,
                ):
                    done[w] = symbols[s : s + n].astype(np.uint32)
            each = np.repeat(least, counts)
            hit = (rank == each) & (each != _NONE)
            if local:
                hit |= self._lowest_around(rank)
            # A pair of equal symbols may overlap itself: of a run of hits every second counts.
            spot = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(spot) > 1)) if len(spot) else np.zeros(0, bool)
            first = spot[np.maximum.accumulate(np.where(run, np.arange(len(spot)), 0))]
            spot = spot[(spot - first) % 2 == 0]
            symbols[spot] = self.made[at[spot]]
            stay = each != _NONE
            stay[spot + 1] = False
            symbols, word = symbols[stay], word[stay]
        return done

    def _lowest_around(self, rank: np.ndarray) -> np.ndarray:
        """The pairs that no merge elsewhere can come before.

        Before a pair's turn one of its symbols could only go to a token made of the symbols
        next to it, all of whose merges come earlier, the first of them between two symbols
        within the reach of a token. So a pair with the lowest rank within that reach is merged
        in any case. Of a run of equal pairs either all fulfil this or none is taken, as its
        start decides which of them merge.
        """
        n = len(rank)
        padded = np.concatenate([np.full(self.reach, _NONE), rank, np.full(self.reach, _NONE)])
        width, low = 1, padded
        while 2 * width <= 2 * self.reach + 1:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        rest = 2 * self.reach + 1 - width
        low = np.minimum(low[:n], low[rest : rest + n])
        lowest = (rank == low) & (rank != _NONE)
        begin = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        whole = np.minimum.reduceat(lowest.astype(np.int8), begin)
        return np.repeat(whole == 1, np.diff(np.append(begin, n)))

    def _chunks(self, text: str) -> list[str]:
        """A text cut at white space; a control string gets a space in front, as no other chunk.

        Words that are cut out already get two.
        """
        out: list[str] = []
        for part in self.added_pattern.split(text) if "<|" in text else (text,):
            if part in self.added:
                out.append(f" {part}")
                continue
            if not part.isascii():
                if self.newer.concerns(part):
                    out += [f"  {w}" for w in self.newer.words(part)]
                    continue
                # Lower case letter by letter: a final sigma has no form of its own here.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            # Python also splits at four control characters that are no Unicode white space.
            out += _GAPS.split(part) if _ODD_GAPS.search(part) else part.split()
        return out

    @staticmethod
    def _pieces(chunk: str) -> list[str]:
        return [chunk[2:]] if chunk.startswith("  ") else _PIECES.findall(chunk)

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of new chunks to the flat store; words never cross a chunk."""
        pieces = [self._pieces(c) for c in chunks]
        words = list(set().union(*pieces))
        ids = self.merge_words(words)
        number = {w: i for i, w in enumerate(words)}
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
        flat = np.concatenate([self.flat[:0], *ids])
        got, ends = _gather(flat, bounds, [number[w] for ps in pieces for w in ps], pieces)
        for i, c in enumerate(chunks, len(self.cache)):
            self.cache[c] = i
        self.flat = np.concatenate([self.flat, got])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + ends])
        self.uses = np.concatenate([self.uses, np.zeros(len(chunks), dtype=np.int64)])

    def _forget(self) -> None:
        self.cache = {f" {t}": i for i, t in enumerate(self.added)}
        self.flat = np.array(list(self.added.values()), dtype=np.uint32)
        self.bounds = np.arange(len(self.added) + 1, dtype=np.int64)
        self.uses = np.zeros(len(self.added), dtype=np.int64)

    def _thin_out(self) -> None:
        """Keep the control strings and the chunks that are used most; older uses count half.

        Most chunks of a text occur once; those that come back are few.
        """
        first = len(self.added)
        often = np.argsort(-self.uses[first:], kind="stable")[: CACHED_CHUNKS // 2] + first
        kept = np.concatenate([np.arange(first), np.sort(often)]).tolist()
        # A chunk's number is its place in the order of insertion.
        chunks = list(self.cache)
        self.flat, ends = _gather(self.flat, self.bounds, kept, [[i] for i in kept])
        self.bounds = np.concatenate(([0], ends))
        self.uses = self.uses[kept] // 2
        self.cache = {chunks[i]: n for n, i in enumerate(kept)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        chunks = [self._chunks(t) for t in texts]
        if len(self.cache) > CACHED_CHUNKS:
            self._thin_out()
        fresh = list(set().union(*chunks) - self.cache.keys())
        if fresh:
            self._learn(fresh)
        number = self.cache.__getitem__
        picks = [i for cs in chunks for i in map(number, cs)]
        self.uses += np.bincount(np.array(picks, dtype=np.int64), minlength=len(self.uses))
        ids, ends = _gather(self.flat, self.bounds, picks, chunks)
        return np.split(ids, ends[:-1])

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' texts with a space between, as the file names no decoder."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One vocabulary for each worker process."""
    return Bpe(path)


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", keep: str = "doc_id", digests: bool = False
) -> DataFrame:
    """Token ids of every whole text, and what they decode to.

    ``path`` names the vocabulary file, which every worker can read. Returns ``keep``,
    n_tokens, ids (little-endian unsigned 32-bit integers) and decoded; with ``digests``
    instead of the last two their SHA-256 as ids_sha256 and decoded_sha256. One row for each
    row; a null text is empty and an empty text has no tokens; repeated rows repeat; a text
    or a word in it may have any length; an empty table gives an empty table; other columns
    are left out. Nothing is shuffled.
    """
    source = docs.select(docs[keep].alias("key"), docs[text].alias("text"))
    kind = docs.schema[keep].dataType.simpleString()
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for rows in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            texts = [t or "" for t in rows.column(1).to_pylist()]
            for a, z in byte_slices(texts, SLICE_BYTES):
                ids = bpe.encode(texts[a:z])
                raw = [i.astype("<u4").tobytes() for i in ids]
                plain = [bpe.decode(i) for i in ids]
                if digests:
                    raw = [hashlib.sha256(r).hexdigest() for r in raw]
                    plain = [hashlib.sha256(p.encode("utf-8")).hexdigest() for p in plain]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).slice(a, z - a),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array(raw, pa.string() if digests else pa.binary()),
                        pa.array(plain, pa.string()),
                    ],
                    ["key", "n_tokens", *names],
                )

    first = "string" if digests else "binary"
    out = source.mapInArrow(run, f"key {kind}, n_tokens bigint, {names[0]} {first}, {names[1]} string")
    return out.withColumnRenamed("key", keep)
