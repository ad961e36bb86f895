"""Pipeline stages: (spark, docs, sf_dir) -> what goes on to the next stage.

Every row gets the verdict of its own text, also rows without a doc_id and
rows that repeat one; of a group of copies one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, line_dedup, near_dup, toxicity
from .store import lean_workers, small, stored, table


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(``docs`` with a key of each row, the key's name). The key is the doc_id
    where every row has its own, else a number in order of doc_id, nulls last."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col("doc_id").cast("long"))).first()
    if rows == ids:
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    ordered = docs.orderBy(F.col("doc_id").cast("long").asc_nulls_last(), F.xxhash64("text"))
    return stored(ordered.withColumn(key, F.monotonically_increasing_id()), f"{name}-rows"), key


def texts(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("doc_id"), "text")


def dropped(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` without those whose key is in ``keys`` (one long column doc_id)."""
    keys = small(stored(keys.select(F.col("doc_id").alias(key)).distinct(), f"{name}-ids"))
    return rows.join(keys, key, "left_anti").select(rows.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores at one half or more go."""
    lean_workers(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows, key = keyed(docs, "toxic")
    bad = toxicity.toxicity(texts(rows, key), model).filter("score >= 0.5").select("doc_id")
    return dropped(rows, key, bad, "toxic").drop(key)


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that repeat an earlier one but for two edits, short ones if equal; a
    document goes only when no line with a word is left. Near copies, by the next
    stage's measure, with something of their own left stay whole for that stage."""
    lean_workers(spark)
    rows, key = keyed(docs, "line-dedup")
    return line_dedup.without_repeats(rows, key=key, copies=(5, 80)).drop(key)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the smallest doc_id."""
    lean_workers(spark)
    rows, key = keyed(docs, "near-dedup")
    found = near_dup.near_duplicates(texts(rows, key), k=5, percent=80)
    return dropped(rows, key, found.filter(~F.col("kept")).select("doc_id"), "near-dedup").drop(key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    lean_workers(spark)
    rows, key = keyed(docs, "decontaminated")
    found = decontaminate.contamination(texts(rows, key), table(spark, sf_dir, "benchmark"))
    return dropped(rows, key, found.filter(F.size("spans") > 0).select("doc_id"), "decontaminated").drop(key)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its number of tokens and the digests of its token
    ids and of the text decoded from them; none goes. Columns of these three
    names that ``docs`` has are replaced."""
    lean_workers(spark)
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encoded_digests(docs, bpe.tokenizer_path(), keep=tuple(c for c in docs.columns if c not in made))
