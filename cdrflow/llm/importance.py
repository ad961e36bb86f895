"""Importance resampling of documents towards a target collection.

Words (or runs of words) are hashed into buckets by CRC-32. A bucket's gain is
the rounded log ratio of its share in the target to its share in the documents;
a document's weight is the mean gain of its features. Noise that depends on the
doc_id alone turns the weights into scores whose highest are a draw without
replacement in proportion to the weights.

Scale. Two passes over the texts: one counts buckets, a numpy array per task and
at most one row per task and bucket; the other scores. Only bucket counts (their
number is a parameter) and counts per score (whole thousandths of a logarithm,
of some ten thousands of values) come to the driver. The draw sorts no more than
the rows at or above the score where it ends, by score and id over ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .crc import crc32
from .ranks import ranked
from .store import stored

BUCKETS = 10_000
#: Words of a feature: runs of LEAST to MOST consecutive ones.
LEAST, MOST = 1, 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024


def spaced(w: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the words with one space behind each, so that a
    run of consecutive words is one span."""
    size = w.ends - w.starts
    ends = np.cumsum(size + 1) - 1
    data = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    shift = np.repeat(w.starts - (ends - size), size)
    to = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
    data[to] = w.text[to + shift]
    return data, ends - size, ends


def features(w: tokens.Words, least: int, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of the runs of each length from ``least`` to ``most``."""
    owner = tokens.owners(w.offsets)
    data, starts, ends = (w.text, w.starts, w.ends) if most == 1 else spaced(w)
    for k in range(least, most + 1):
        n = len(starts) - k + 1
        if n <= 0:
            return
        inside = np.flatnonzero(owner[:n] == owner[k - 1:])
        yield crc32(data, starts[inside], ends[inside + k - 1]) % np.uint32(buckets), owner[inside]


def bucket_counts(docs: DataFrame, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, w in tokens.slices(batch.column(0), tokens.ALNUM):
                for found, _ in features(w, least, most, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's share in the target over that in the source, each with one more."""
    buckets = len(source)
    s_all, t_all = float(source.sum()) + buckets, float(target.sum()) + buckets
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row; weight is 0 without features."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            n_words, n, total = (np.zeros(size, np.int64) for _ in range(3))
            for at, to, w in tokens.slices(batch.column(1), tokens.ALNUM):
                n_words[at:to] = w.counts
                for found, owner in features(w, least, most, len(gain)):
                    n[at:to] += np.bincount(owner, minlength=to - at)
                    np.add.at(total[at:to], owner, gain[found])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n), pa.array(weight)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))), u drawn by a digest of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
              least: int = LEAST, most: int = MOST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank counts
    the drawn ones from 1 by falling score, ties to the smaller doc_id, and is null for others.

    Texts are cut into lower-case words of digits, letters and non-ASCII
    characters; null and empty ones have none and are never drawn while
    ``min_words`` is positive. A null doc_id is drawn with the noise of an empty
    one, after all ids of its score. Rows that repeat a doc_id are scored and
    drawn each. An empty target gives every bucket its smoothed share. Columns
    other than doc_id and text are ignored.
    """
    gain = gains(bucket_counts(docs, least, most, buckets), bucket_counts(target, least, most, buckets))
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    rows = stored(weights(docs, gain, least, most).withColumn("score", score)
                  .withColumn("row", F.monotonically_increasing_id()), "importance")
    long_enough = F.col("n_words") >= min_words
    per_score = sorted(rows.filter(long_enough).groupBy("score").count().collect(), reverse=True)
    drawn = percent * sum(n for _, n in per_score) // 100
    cut, n = None, 0
    for cut, more in per_score:  # the score where the draw ends
        n += more
        if n >= drawn:
            break
    columns = ["doc_id", "n_features", "weight", "score"]
    if not drawn:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    near = long_enough & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    top = ranked(rows.filter(near), order, "importance")
    rank = F.when(F.col("at") < drawn, F.col("at") + 1)
    return top.select(*columns, rank.alias("rank")).unionAll(
        rows.filter(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
