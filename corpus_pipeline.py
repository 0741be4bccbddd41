"""From raw documents to token ids: the stages of a training corpus, each stored.

Every stage reads all that its predecessor kept and its decisions take effect: rejected
documents, near copies and contaminated documents go, what is left is encoded. The fitted
stages learn from the raw table, as after the first stage hardly a bad document is left to
learn from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trailmart.llm import byte_bpe, contamination, line_quality, quality_classifier, simhash
from trailmart.llm.common import stored, table
from trailmart.llm.queries import BYTE_BPE


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    raw, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.accepted(docs, quality_classifier.learn(raw, labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the quality rules."""
    raw, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return line_quality.accepted(docs, line_quality.learn(raw, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class that SimHash links: three words, two bits at most."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that repeat benchmark passages."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of their decoding."""
    path = public_tokenizers.path(BYTE_BPE)
    return byte_bpe.round_trip_digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]
#: Fitted models, similarity classes and token merges have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
