"""The queries of this subpackage over the test tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.llm import (
    byte_bpe,
    collocations,
    contamination,
    hard_negatives,
    license_scan,
    line_quality,
    minmax_hash,
    quality_classifier,
    simhash,
    token_counts,
    toxicity,
    url_reputation,
    warc,
)
from trailmart.llm.common import table

WORD_BPE, TOKEN_LIMIT = "word_bpe_49k.json", 2_048
URL_RULES = (
    url_reputation.Rule("block", "net", "/"),
    url_reputation.Rule("allow", "example.net", "/en/"),
    url_reputation.Rule("block", "example.com", "/de/"),
    url_reputation.Rule("allow", "org", "/fr/"),
)
MINMAX_WORDS, MINMAX_PERCENT = 3, 85
FINENESS, ANCHOR_STEP, PER_ANCHOR, SCORE_WINDOW = 256, 100, (5, 10), (30, 90)
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(WORD_BPE),
        TOKEN_LIMIT,
        keys=["doc_id"],
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    names = "array_join(array_sort(transform(items, i -> CAST(i AS STRING))), ',')"
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "CAST(size(items) AS BIGINT) AS n_items",
        f"sha2({names}, 256) AS items_sha256",
        "contaminated",
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_BPE),
        public_tokenizers.PATTERN,
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return marked.select(
        "doc_id", simhash.fingerprint_text("fp").alias("fingerprint"), "component_id"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_hash.near_duplicates(
        table(spark, sf_dir, "documents"), MINMAX_WORDS, MINMAX_PERCENT
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ids divisible by 7 the label is the next one; anchors are ids divisible by 100."""
    given = table(spark, sf_dir, "embeddings").filter(hard_negatives.complete("embedding"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = given.select(
        "vec_id", moved.alias("label"), hard_negatives.integers("embedding", FINENESS).alias("q")
    )
    return hard_negatives.mined(
        vectors, F.col("vec_id") % ANCHOR_STEP == 0, PER_ANCHOR, SCORE_WINDOW
    )


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scanned(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_warc": op2_warc,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_contamination": op5_contamination,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_url_reputation": op7_url_reputation,
    "op8_simhash": op8_simhash,
    "op9_license_scan": op9_license_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_minmax": op11_minmax,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op7_url_reputation": url_reputation.oracle(URL_RULES),
    "op9_license_scan": license_scan.oracle(),
    "op11_minmax": minmax_hash.oracle(MINMAX_WORDS, MINMAX_PERCENT),
    "op12_collocations": collocations.oracle(),
    "op13_hard_negatives": hard_negatives.oracle(
        ANCHOR_STEP, FINENESS, PER_ANCHOR, SCORE_WINDOW
    ),
}
