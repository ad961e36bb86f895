"""Labelled documents for fitting: a bounded sample, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def bucket(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def training_texts(docs: DataFrame, labels: DataFrame, column: str, modulus: int, held: int,
                   most: int, name: str) -> DataFrame:
    """(doc_id, label, text) of at most ``most`` labelled rows outside the held-out bucket.

    The rows are those with the smallest hash of their doc_id, so the sample
    doesn't depend on partitioning. Null ids and labels other than 0 and 1
    are not used; an id labelled both ways counts as 1. Of the texts of a
    repeated id the smallest is taken, a null one only where there is no other.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
            .filter(F.col("label").isin(0, 1) & (bucket(modulus) != held))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the bound of the broadcast below
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
                  .agg(F.min("text").alias("text")), f"{name}-training")
