"""URL filter by the likelihood ratio of two character language models.

Rules on host and path decide many URLs at once. Those decisions are the
examples: one variable-order Markov model of the accepted URLs' characters,
one of the rejected. Each order is smoothed into the next lower one by the
number of distinct characters seen after the context (Witten-Bell). A URL
without a rule is blocked when its length-normalised log-likelihood
difference is under a threshold, calibrated on examples held out of the
counts: at most a stated share of accepted URLs falls under it, and it lies
no higher than nearly all rejected ones.

Scale. Character counts of all examples are summed per task and then by
Spark; contexts are hashed into tables of a fixed size, so the broadcast
models have a proven bound. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .store import stored

ORDER = 5                   # characters of context at most
BITS = 18                   # size of each hashed count table
HOLD = 5                    # one in HOLD examples calibrates
LOSS = 0.01                 # share of accepted examples that may fall under the threshold, and of rejected ones above
GRID = 4_096                # cells of scores that are counted at a time; so many scores come to the driver at most

#: (host suffix, path prefix, verdict); the longest that fits wins.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ://."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=None) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(RULES if rules is None else rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _contexts(text: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, slot of the context, slot of context and character) for every byte that has so long a context."""
    place = np.arange(len(text)) - np.repeat(bounds[:-1], np.diff(bounds))
    x = text.astype(np.uint64) + np.uint64(1)
    context = np.zeros(len(text), np.uint64)
    shift = np.uint64(64 - BITS)
    for order in range(ORDER + 1):
        if order:
            older = np.zeros(len(text), np.uint64)
            older[order:] = x[:-order] if order < len(x) else x[:0]
            context = tokens.mix(context + older * tokens.STEP + np.uint64(order))
        # At a url's start the context is the beginning itself.
        known = np.where(place >= order, context, np.uint64(7 * order + 1)) if order else context
        slot = tokens.mix(known + np.uint64(order))
        yield order, (slot >> shift).astype(np.int64), (tokens.mix(slot + x) >> shift).astype(np.int64)


def _url_bytes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = tokens.raw(column)
    for at, to in tokens.cut(offsets):
        bounds = offsets[at: to + 1] - offsets[at]
        yield at, to, tokens.LOWER[data[offsets[at]: offsets[to]]], bounds


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(accepted, url) -> per task: model, table, slot, n. Tables: 2 * order for
    contexts, 2 * order + 1 for contexts with a character."""
    total = np.zeros((2, 2 * (ORDER + 1), 1 << BITS), np.int32)
    for batch in batches:
        kind = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, to, text, bounds in _url_bytes(batch.column(1)):
            own = np.repeat(kind[at:to], np.diff(bounds))
            for order, context, pair in _contexts(text, bounds):
                for model in (0, 1):
                    mine = own == model
                    total[model, 2 * order] += np.bincount(context[mine], minlength=1 << BITS).astype(np.int32)
                    total[model, 2 * order + 1] += np.bincount(pair[mine], minlength=1 << BITS).astype(np.int32)
    for model in (0, 1):
        for table in range(total.shape[1]):
            slot = np.flatnonzero(total[model, table])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slot), model, np.int32)), pa.array(np.full(len(slot), table, np.int32)), pa.array(slot.astype(np.int32)),
                 pa.array(total[model, table, slot].astype(np.int64))], names=["model", "table", "slot", "n"])


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(accepted, url) -> distinct (model, order, context, pair) per batch: which characters follow a context."""
    for batch in batches:
        kind = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, to, text, bounds in _url_bytes(batch.column(1)):
            own = np.repeat(kind[at:to], np.diff(bounds))
            for order, context, pair in _contexts(text, bounds):
                key = np.unique((own << (2 * BITS)) | (context << BITS) | pair)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), order, np.int32)), pa.array(key)], names=["order", "key"])


@dataclass
class Model:
    """Per model (0 rejected, 1 accepted) and order: hashed counts, and distinct followers of contexts."""

    counts: np.ndarray     # (2, 2 * (ORDER + 1), slots)
    follow: np.ndarray     # (2, ORDER + 1, slots)
    threshold: float

    def difference(self, text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean log-likelihood difference per byte, accepted minus rejected; 0 for an empty text."""
        p = np.full((2, len(text)), 1 / 256)
        for order, context, pair in _contexts(text, bounds):
            for m in (0, 1):
                n, t = self.counts[m, 2 * order][context].astype(float), self.follow[m, order][context].astype(float)
                c = np.minimum(self.counts[m, 2 * order + 1][pair], n)
                p[m] = np.where(n > 0, (c + t * p[m]) / np.maximum(n + t, 1), p[m])
        ratio = np.concatenate([[0], np.cumsum(np.log(p[1]) - np.log(p[0]))])
        return (ratio[bounds[1:]] - ratio[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def _differences(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, text, bounds in _url_bytes(batch.column(batch.num_columns - 1)):
                passed = [batch.column(i).slice(at, to - at) for i in range(batch.num_columns - 1)]
                names = batch.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([*passed, pa.array(shared.value.difference(text, bounds))], names=[*names, "difference"])
    return run


def kth(values: DataFrame, k: int) -> float:
    """The k-th smallest, from 0, of one column of doubles: values are counted in GRID
    cells, then again within the cell that holds it, until few are left."""
    x = F.col(values.columns[0])
    while True:
        low, high, n = values.agg(F.min(x), F.max(x), F.count(x)).first()
        if low == high:
            return low
        if n <= GRID:
            return sorted(r[0] for r in values.collect())[k]
        cell = F.least(F.floor((x - low) / ((high - low) / GRID)), F.lit(GRID - 1))
        for place, m in sorted(values.groupBy(cell.alias("cell")).count().collect()):
            if k < m:
                break
            k -= m
        values = values.filter(cell == place)


def fit(examples: DataFrame, loss: float = LOSS) -> Model:
    """A model from ``examples`` (accepted boolean, url); null urls count as empty.

    Without held-out examples of both kinds the threshold lets all pass.
    """
    spark = examples.sparkSession
    rows = examples.select(F.col("accepted").cast("int").alias("accepted"), F.coalesce("url", F.lit("")).alias("url"))
    held = F.pmod(F.xxhash64("url"), F.lit(HOLD)) == 0
    rows = stored(rows.withColumn("held", held), "urls-examples")
    seen = rows.filter(~F.col("held")).select("accepted", "url")
    size = 1 << BITS
    model = Model(np.zeros((2, 2 * (ORDER + 1), size), np.float32), np.zeros((2, ORDER + 1, size), np.float32), -np.inf)
    # At most 2 * 2 * (ORDER + 1) * size numbers, whatever the number of examples.
    counts = (seen.mapInArrow(_counted, "model int, table int, slot int, n long")
              .groupBy("model", "table", "slot").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    model.counts[counts["model"], counts["table"], counts["slot"]] = counts["n"]
    follow = (seen.mapInArrow(_kinds, "order int, key long").distinct()
              .groupBy("order", F.shiftright("key", BITS).alias("slot")).count().toArrow().to_pandas())
    slot = follow["slot"].to_numpy(np.int64)
    model.follow[slot >> BITS, follow["order"], slot & (size - 1)] = follow["count"]
    shared = spark.sparkContext.broadcast(model)
    scored = stored(rows.filter("held").select("accepted", "url").mapInArrow(_differences(shared), "accepted int, difference double"), "urls-scored")
    limits = []
    for kind, share in ((1, loss), (0, 1 - loss)):
        mine = scored.filter(F.col("accepted") == kind).select("difference")
        n = mine.count()
        if n:
            limits.append(kth(mine, int(np.floor(share * (n - 1)))))
    if len(limits) == 2:
        model.threshold = min(limits)
    return model


def judged(pages: DataFrame, rules=None, loss: float = LOSS) -> DataFrame:
    """page_id, host, path, rule, verdict, difference for each row of ``pages`` (page_id, url).

    A null or malformed url has no host and path, fits no rule, and is judged
    by its characters alone; repeated rows are judged each by itself; an empty
    table gives an empty result. Other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    ruled = parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    model = fit(ruled.filter("r is not null").select((F.col("r.verdict") == "allow").alias("accepted"), "url"), loss)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = ruled.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"), "url")
    kind = rows.schema["page_id"].dataType.simpleString()
    out = rows.mapInArrow(_differences(shared), f"page_id {kind}, host string, path string, rule string, verdict string, difference double")
    own = F.when(F.col("difference") < model.threshold, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("verdict", own))
