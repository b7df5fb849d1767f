"""The corpus pipeline: stages that each take the documents that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import bpe, linededup, mixing, simhash, toxicity
from railyard.llm.common import fold, staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts; it learns from the same folds as its query."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels, fold(labels["doc_id"], 4) != 2)
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand earlier; n_chars follows the text."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs, words=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that their sources come near their targets."""
    return mixing.mix(docs, mixing.cyclic_weights(docs, "source", (3, 1, 2)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", keep_one_of_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
