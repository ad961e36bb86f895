"""A training-data pipeline over ``documents``: STAGES, run() and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdrflow.llm import stages
from cdrflow.llm.store import stored, table

#: (name, function): each function takes (spark, docs, sf_dir), returns what goes on.
STAGES = [
    ("toxicity", stages.not_toxic),
    ("line dedup", stages.line_deduped),
    ("minhash near-dedup", stages.near_dedup),
    ("benchmark decontamination", stages.decontaminated),
    ("bpe encoding and decoding", stages.tokenised),
]

#: The statistical stages can't be written in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{i}")
    return docs
