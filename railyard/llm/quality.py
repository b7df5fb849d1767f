"""Quality score from compression with dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame

from railyard.llm.common import class_weights, fit_logistic, labelled_sample

#: Bytes of one compressed block. A whole text is compressed block by block, each afresh, so
#: that the dictionary counts as much at a long text's end as at its start.
BLOCK = 2_048
DICTIONARY = 65_536
_LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Both dictionaries, and the calibration: a logistic curve over the compressed sizes."""

    good: bytes
    bad: bytes
    middle: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.middle) / self.scale) @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    made = []
    for raw in (good, bad):
        held = zstandard.ZstdCompressionDict(raw) if raw else None
        if held:
            held.precompute_compress(level=_LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=_LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


def sizes(text: str | None, good, bad) -> list[float]:
    """The normalised difference of a text's compressed sizes, its steepness, and its size.

    First the bytes that the good dictionary saves against the bad one for each byte of text,
    then the same for each compressed byte, then compressed bytes for each byte of text: what
    repeats itself shrinks alike with either dictionary, and much.
    """
    data = (text or "").encode("utf-8")
    if not data:
        return [0.0, 0.0, 1.0]
    with_good = with_bad = 0
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK]
        with_good += len(good.compress(block))
        with_bad += len(bad.compress(block))
    gain = with_bad - with_good
    return [gain / len(data), gain / (with_bad + with_good), min(with_good / len(data), 1.0)]


def _dictionary(texts: list[str]) -> bytes:
    blocks = []
    for t in texts:
        data = t.encode("utf-8")
        blocks += [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks, k=256, d=6).as_bytes()
    except zstandard.ZstdError:
        # Too little text to train on: it is the dictionary itself.
        return b"".join(blocks)[-DICTIONARY:]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    rows_per_class: int = 4_000,
    max_chars: int = 60_000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> QualityModel:
    """Fit on at most ``rows_per_class`` labelled texts of each class.

    Two thirds of the sample make the dictionaries; the rest, which no dictionary has seen,
    calibrates. Without labels of both classes scores lean to the one seen; without any they are 0.5.
    """
    sample, counts = labelled_sample(docs, labels, label, train, rows_per_class, max_chars, key, text)
    seen: dict[str, int] = {}
    parts: dict[bool, list[tuple[str, int]]] = {True: [], False: []}
    for t, y in sample:
        if t in seen:  # a copy in the calibration rows would look too good
            continue
        seen[t] = len(seen)
        parts[len(seen) % 3 != 0].append((t, y))
    good = _dictionary([t for t, y in parts[True] if y])
    bad = _dictionary([t for t, y in parts[True] if not y])
    tools = _compressors(good, bad)
    x = np.array([sizes(t, *tools) for t, _ in parts[False]]).reshape(-1, 3)
    y = np.array([float(y) for _, y in parts[False]])
    middle = x.mean(axis=0) if len(x) else np.zeros(3)
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0) if len(x) else np.ones(3)
    beta = fit_logistic((x - middle) / scale, y, class_weights(y, counts))
    return QualityModel(good, bad, middle, scale, beta)


def score_quality(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and score (0 to 1, higher: better) of every row, from its whole text.

    Null and empty texts save nothing either way and have the score that belongs to it. Rows repeat
    as they are; other columns are left out. Nothing is shuffled; the model travels with the
    task (two dictionaries of at most 64 KB).
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _compressors(model.good, model.bad)
        for batch in batches:
            x = np.array([sizes(t.as_py(), *tools) for t in batch.column(1)]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["key", "score"])

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
