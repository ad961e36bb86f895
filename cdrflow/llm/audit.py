"""Filter interaction audit over every order of five filters.

A document is known to the audit by its mask, the set of filters that it
fails. In an order of filters it is removed by the first one in its mask. All
orders that share a prefix are neighbours in lexicographic order, so the orders
in which a mask is removed at one step are a few intervals of Lehmer ranks: a
prefix of filters outside the mask, then one inside. Counts are added at the
first rank of each interval and taken off behind its last; a prefix sum over
the 120 ranks then gives what every order removes at that step.

Scale. Texts are read once and leave the first stage as a digest and a mask.
Rows with equal (doc_id, digest, part, mask) are one row before any join. The
earlier-copy test joins on (digest, doc_id), so a text that a third of all rows
share is still spread over all tasks. What reaches the audit is one row of
counts per part and mask, at most 32 a part, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import WORD, let, words
from .store import stored

LETTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")


def default_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions A to D of a text column; E, the earlier copy, needs the table."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return {
        "A": F.regexp_count(t, F.lit(WORD)) < 200,
        "B": let(words(t), lambda w: 100 * F.size(F.array_distinct(w)) < 50 * F.size(w)),
        "C": 100 * F.regexp_count(t, F.lit("[A-Z]")) > 2 * F.length(t),
        "D": t.rlike(r"[#$%&*|]"),
    }


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per source and set of failed filters.

    Bit i of mask stands for the i-th of ``LETTERS``. A null text is an empty
    one. A null or empty source is the part ''. A null doc_id is smaller than
    none: such a row fails no E, makes no other fail it, and has no label. Rows
    that repeat a doc_id count each. An id labelled several times has a label
    if any of its rows does.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(default_filters().values())]
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                              F.unhex(F.sha2(t, 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
                  .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    first = (rows.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .filter("doc_id is not null")
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
             .withColumn("spread", F.lit(0).cast("long")))
    # Rows without an id match nothing; their digest deals them over the tasks.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    rows = rows.join(first, ["digest", "doc_id"], "left").join(marks, ["doc_id", "spread"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)
    count = [F.sum("n").alias("n")] + [F.sum(F.when(F.col(m), F.col("n")).otherwise(0)).alias(m) for m in MEASURES[1:]]
    return rows.groupBy("part", mask.cast("int").alias("mask")).agg(*count)


def intervals(mask: int, n: int) -> Iterator[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of the orders of ``n`` filters that
    remove ``mask`` at ``step`` (from 0): one for each prefix outside the mask,
    continued by a filter inside it."""
    def walk(left: list[int], step: int, rank: int) -> Iterator[tuple[int, int, int]]:
        width = factorial(max(len(left) - 1, 0))
        for place, f in enumerate(left):
            at = rank + place * width
            if mask >> f & 1:
                yield step, at, at + width
            else:
                yield from walk([x for x in left if x != f], step + 1, at)
    return walk(list(range(n)), 0, 0)


class Ranks:
    """Difference arrays over the ranks of all orders of ``letters``."""

    def __init__(self, letters: str = LETTERS) -> None:
        self.n = n = len(letters)
        self.orders = ["".join(p) for p in permutations(letters)]  # in rank order
        #: filter tried at each step of each order
        self.tried = np.array([[letters.index(x) for x in o] for o in self.orders]).T.copy()
        ends = [(mask, step, rank, sign) for mask in range(1, 1 << n) for step, at, to in intervals(mask, n)
                for rank, sign in ((at, 1), (to, -1))]
        self.mask, self.step, self.rank, self.sign = np.array(ends).T

    def removed(self, counts: np.ndarray) -> np.ndarray:
        """What each (step, rank) removes, of ``counts`` per mask: ranks in the last axis."""
        steps = np.zeros((self.n, len(self.orders) + 1), np.int64)
        np.add.at(steps, (self.step, self.rank), self.sign * counts[self.mask])
        return np.cumsum(steps, axis=1)[:, :-1]

    def report(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """The audit's columns, each (step, rank), of ``counts`` (measure, mask)."""
        n, good, toxic = counts
        removed = self.removed(n)
        masks = np.arange(1 << self.n)
        failing = np.array([n[masks >> f & 1 == 1].sum() for f in range(self.n)])
        only = np.array([n[1 << f] for f in range(self.n)])
        shapley = np.zeros(self.n, np.int64)
        np.add.at(shapley, self.tried, removed)
        return {"kept": n.sum() - np.cumsum(removed, axis=0), "removed": removed,
                "redundant": failing[self.tried] - removed, "unique_fails": only[self.tried],
                "good_lost": self.removed(good), "toxic_lost": self.removed(toxic), "shapley": shapley[self.tried]}


REPORT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame) -> DataFrame:
    """Per part, order and step what the filter of that step removes.

    ``counts`` are the rows of ``masked``. A part has 120 orders of five steps,
    zeros included; an empty table has no part and gives no rows. Columns other
    than the five are ignored.
    """
    masks = 1 << len(LETTERS)
    per_mask = [F.sum(F.when(F.col("mask") == m, F.col(x)).otherwise(0)).alias(f"{x}{m}") for x in MEASURES for m in range(masks)]
    parts = counts.groupBy("part").agg(*per_mask)

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks()
        names = np.repeat(ranks.orders, ranks.n)
        steps = np.tile(np.arange(1, ranks.n + 1, dtype=np.int32), len(ranks.orders))
        for batch in batches:
            table = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1) if batch.num_rows else []
            for part, row in zip(batch.column(0).to_pylist(), table):
                found = ranks.report(row.reshape(len(MEASURES), masks).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(steps),
                     *(pa.array(found[c].T.ravel(), pa.int64()) for c in REPORT)],
                    names=["part", "filter_order", "step", *REPORT])

    return parts.mapInArrow(orders, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in REPORT))
