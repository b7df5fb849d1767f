import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import quality, toxicity
from railyard.llm.common import fold

from tests.llm.conftest import prose


def held_out(doc, folds, out):
    return zlib.crc32(str(doc).encode()) % folds == out


@pytest.fixture
def corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        text = prose(rng, rng.randint(20, 150))
        toxic, good = int(i % 8 == 0), int(i % 5 != 0)
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "trash", "zorblat", "zorbling"]))
            text = " ".join(words)
        if not good:
            text = " | ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "s"))
        labels.append((i, good, toxic))
    return rows, labels


def accuracy(scored, truth, folds, out):
    test = [(r["score"] >= 0.3) == bool(truth[r["doc_id"]]) for r in scored if held_out(r["doc_id"], folds, out)]
    assert len(test) > 100
    return sum(test) / len(test)


def test_quality_on_held_out_rows(spark, frame, corpus, odd_rows):
    rows, labels = corpus
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.fit_quality(frame(rows), marks, fold(F.col("doc_id"), 5) != 0)
    truth = {i: q for i, q, _ in labels}
    assert accuracy(quality.score_quality(frame(rows), model).collect(), truth, 5, 0) > 0.95
    odd = quality.score_quality(frame(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    none = quality.fit_quality(frame([]), marks.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score_quality(frame(odd_rows), none).collect()} == {0.5}
    assert quality.score_quality(frame([]), model).count() == 0


def test_toxicity_on_held_out_rows(spark, frame, corpus, odd_rows):
    rows, labels = corpus
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit_toxicity(frame(rows), marks, fold(F.col("doc_id"), 4) != 2)
    truth = {i: t for i, _, t in labels}
    assert accuracy(toxicity.score_toxicity(frame(rows), model).collect(), truth, 4, 2) > 0.97
    # A stem that no lexicon names was learned.
    odd = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame([(1, "bal zorblatting bel", "s"), (2, "bal bel", "s")]), model).collect()}
    assert odd[1] > 0.3 > odd[2]
    scored = toxicity.score_toxicity(frame(odd_rows), model).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    kept = toxicity.drop_toxic(frame(odd_rows), model)
    assert kept.columns == frame([]).columns and kept.count() == len(odd_rows)
    said = frame([(1, "a calm text", "s"), (2, "you stupid idiot moron", "s"), (3, None, "s"), (4, "what a clown", "s")])
    for few in (marks.limit(0), marks.where("toxic = 1"), marks.where("toxic = 0")):
        unlabelled = toxicity.fit_toxicity(frame(rows), few, F.lit(True))
        score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(said, unlabelled).collect()}
        assert score[1] == score[3] < 0.1 and 0.3 < score[4] < score[2]
        assert toxicity.drop_toxic(frame(odd_rows), unlabelled).count() == len(odd_rows)
    assert toxicity.drop_toxic(frame([]), model).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    hits = [0.8, 0.6, 0.3]
    votes = np.stack([np.where(y, rng.random(4000) < h, rng.random(4000) < 0.05).astype(int) for h in hits], axis=1)
    votes = np.column_stack([votes, votes[:, 0]])  # the last voter copies the first
    votes = np.column_stack([votes, np.where(votes.any(axis=1), 1, -1)])
    known = np.where(np.arange(4000) % 4 == 0, y.astype(float), np.nan)
    post, table, weight = toxicity.label_model(votes, 0.3, known)
    assert table[1, 0, 2] > table[1, 1, 2] > table[1, 2, 2] > 2 * table[0, 2, 2]
    assert weight[0] < 0.7 * weight[2] and weight[3] < 0.7 * weight[2]
    assert ((post > 0.5) == y).mean() > 0.85
