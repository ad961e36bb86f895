"""Registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, bpe, decontaminate, importance, line_dedup, lm, mixture, near_dup, quality, rules, secrets, toxicity,
               urls)
from .labelled import bucket
from .oracle import ORACLE_SQL
from .store import table

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against benchmark windows of ten words."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines that repeat an earlier line but for two edits."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of whole texts; the bucket crc32(doc_id) mod 10 = 0 is held out."""
    return lm.scores(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and character models on every page's url."""
    return urls.judged(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of whole texts and the rule cascade's verdict."""
    return rules.report(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores; labels of the bucket crc32(doc_id) mod 4 = 2 are held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), modulus=4, held=2)
    return quality.quality(docs, model).select(
        "doc_id", (bucket(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of whole texts, and the texts decoded from them, as digests."""
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), bpe.tokenizer_path())


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in whole texts; a document is a repository, its source the owner."""
    return secrets.digest(secrets.secrets(table(spark, sf_dir, "documents")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups on four-word shingles at 0.8."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores and spans; labels of the bucket crc32(doc_id) mod 5 = 0 are held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), modulus=5, held=0)
    return toxicity.toxicity(docs, model).select(
        "doc_id", (bucket(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.to_json("spans").alias("spans"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes at each step of all 120 orders, per source."""
    return audit.audit(audit.masked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the longer documents, drawn by weight towards ``benchmark``."""
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all sources takes of each document."""
    return mixture.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_line_dedup, op3_lm_scores, op4_url_filter, op5_quality_rules, op6_quality_classifier, op7_bpe,
    op8_secrets, op9_near_duplicates, op10_toxicity, op11_filter_audit, op12_importance_resample, op13_source_mix)}
