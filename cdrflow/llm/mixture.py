"""Mixing sources to target weights by balanced sampling (the cube method).

A source with target t and s words is taken t/s times on average: each of its
documents whole times, and once more with the fraction left as its inclusion
probability. The cube method settles these fractions. As long as more documents
are open than there are constraints, a step along the null space of the
constraints (documents, words) moves the probabilities of three of them until
one becomes 0 or 1, and no total changes; in a random direction, so that each
document keeps its probability. At most two documents remain. They are landed on the
corner with the least gap in words, which one exchange of settled documents may
close further: the only step that moves probabilities, of four documents a source.

Scale. All documents stand in one order (source, falling size, hash of doc_id),
found by a range sort, and are cut into blocks of ``BLOCK``. Every block of a source
runs its flight alone and leaves at most two documents open; the open ones of
``FAN`` blocks meet in the next round, until each source has one group. A source
with a third of all rows is so many blocks, and no task holds more than a block.
Sources are a table as well: targets are found by a few aggregates over it.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import WORD
from .ranks import ranked
from .store import stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, in percent of all words.
PERCENT = 150
#: A target is at most so many times its source's words.
MOST = 2
BLOCK = 4_000
#: Blocks whose open documents meet in the next round.
FAN = 2_000
SEED = 2024
#: Probabilities this near to 0 or 1 are settled.
CLOSE = 1e-9


def sources(docs: DataFrame, weights: tuple[int, ...], percent: int, most: float) -> DataFrame:
    """(missing, source, source_size, target, first, last): targets of the sources of
    ``docs`` (missing, source, size, at), with their first and last place.

    Weights go round by place of the source in code point order. A target over
    its bound stops there, and what is over is shared again by weight among
    the others, until none is above. Where all have stopped, the rest is given up.
    """
    per = stored(docs.groupBy("missing", "source").agg(
        F.sum("size").alias("source_size"), F.min("at").alias("first"), F.max("at").alias("last")), "mixture-sources")
    place = F.col("at") % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    per = ranked(per, [F.col("missing"), F.col("source")], "mixture").withColumn("weight", weight).drop("at")
    bound = F.col("source_size") * F.lit(float(most))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = None, None
    while True:  # a source stops once and for all, mostly several in a round
        full = F.lit(False) if share is None else F.col("weight") * share >= bound
        n, taken, left = per.agg(F.count_if(full), F.sum(F.when(full, bound).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == stopped or not left:
            break
        stopped, share = n, (total * percent / 100 - taken) / left
    target = F.least(bound, F.col("weight") * F.lit(0.0 if share is None else share))
    return per.withColumn("target", target).drop("weight")


def flight(p: list[float], size: list[int], rng: random.Random) -> list[int]:
    """Moves the probabilities ``p`` in place, in the order given, until at most two
    are open, and returns the places of these.

    The sums of p and of p * size stay as they are but for rounding; each p
    keeps its expected value.
    """
    open_: list[int] = []
    for i in range(len(p)):
        if not CLOSE < p[i] < 1 - CLOSE:
            p[i] = float(round(p[i]))
            continue
        open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = (size[j] for j in open_)
        # The null space of the columns (1, size); for three equal sizes any two documents do.
        u = (c - b, a - c, b - a) if (a, b) != (b, c) else (1, -1, 0)
        up = min(((1 - p[j]) if d > 0 else p[j]) / abs(d) for j, d in zip(open_, u) if d)
        down = min((p[j] if d > 0 else (1 - p[j])) / abs(d) for j, d in zip(open_, u) if d)
        step = up if rng.random() * (up + down) < down else -down
        for j, d in zip(open_, u):
            p[j] += step * d
            if not CLOSE < p[j] < 1 - CLOSE:
                p[j] = float(round(p[j]))
        open_ = [j for j in open_ if 0 < p[j] < 1]
    return open_


def land(p: list[float], size: list[int], open_: list[int], words: float) -> None:
    """Settles the open ``p`` so that sum(p * size) comes nearest to ``words``.

    A large document that is left open can't be landed near by itself, so each
    corner of the open ones is tried with at most one document put in and one
    taken out for it; of equally near ones the first with fewest exchanges.
    """
    s = np.array(size, np.int64)
    settled = np.array(p)
    settled[open_] = -1
    ins, outs = np.flatnonzero(settled == 1), np.flatnonzero(settled == 0)
    ins, outs = (x[np.argsort(s[x], kind="stable")] for x in (ins, outs))
    give, take = (np.concatenate([[0], s[x]]) for x in (ins, outs))  # place 0: no document
    best = None
    for corner in product((0, 1), repeat=len(open_)):
        gap = words - s[ins].sum() - sum(size[i] for i, x in zip(open_, corner) if x)
        wanted = gap + give
        at = np.searchsorted(take, wanted)
        for near in (np.clip(at - 1, 0, len(take) - 1), np.clip(at, 0, len(take) - 1)):
            left = np.abs(wanted - take[near]).round(6)
            i = int(np.argmin(left))
            for g, t in ((0, 0), (0, int(near[0])), (i, int(near[i]))):
                key = (round(abs(gap + give[g] - take[t]), 6), (g > 0) + (t > 0), corner, g, t)
                best = key if best is None or key < best else best
    _, _, corner, g, t = best
    for i, x in zip(open_, corner):
        p[i] = float(x)
    if g:
        p[ins[g - 1]] = 0.0
    if t:
        p[outs[t - 1]] = 1.0


def _round(rows: DataFrame, per_group: int, last: bool, seed: int, name: str) -> DataFrame:
    """One round of flights: groups of a source's places, ``per_group`` blocks each."""
    def fly(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        p, size = group["p"].to_pylist(), group["size"].to_pylist()
        words = sum(x * n for x, n in zip(p, size))
        rng = random.Random(f"{seed}:{key[0].as_py()}:{key[1].as_py()}:{key[2].as_py()}:{per_group}")
        open_ = flight(p, size, rng)
        if last:
            land(p, size, open_, words)
        return group.set_column(group.column_names.index("p"), "p", pa.array(p, pa.float64()))

    group = F.floor(F.col("block") / per_group).alias("group")
    return stored(rows.groupBy("missing", "source", group).applyInArrow(fly, rows.schema), name)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: float = MOST,
          block: int = BLOCK, fan: int = FAN, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row of ``docs``:
    how often the mix takes it.

    Null and empty texts have size 0; they are drawn like others and add no
    words. A null source is a source of its own, last in order, apart from the
    empty one. Rows that repeat a doc_id, and rows without one, are drawn each;
    among equal rows the one that is taken is arbitrary, how many are is not. The
    result depends on the rows and ``seed`` alone. An empty table gives none.
    Columns other than doc_id, text and source are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    slim = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.isNull().cast("int").alias("missing"),
        F.coalesce(source, F.lit("")).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row")), "mixture-sizes")
    # Neither the hash nor the size of a row shows its number, which only parts equal rows.
    order: list[Column] = [F.col("missing"), F.col("source"), F.col("size").desc(),
                           F.xxhash64("doc_id"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    placed = ranked(slim, order, "mixture-places").drop("row").withColumn("block", F.floor(F.col("at") / block))
    # A source's row once for each of its blocks: the join has no hot key.
    per = (sources(placed, weights, percent, most)
           .withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block))))
           .drop("first", "last"))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (placed.join(per, ["missing", "source", "block"]).withColumn("times", times)
            .withColumn("whole", F.floor("times")).withColumn("p", F.col("times") - F.col("whole")).drop("times"))
    n = slim.count()
    per_group, out, done = 1, None, False
    while not done:
        done = per_group > n // block  # every source is one group
        rows = _round(rows, per_group, done, seed, f"mixture-{per_group}")
        settled = rows if done else rows.filter("p in (0, 1)")
        out = settled if out is None else out.unionAll(settled)
        rows, per_group = rows.filter("p not in (0, 1)"), per_group * fan
    return out.select("doc_id", F.when(F.col("missing") == 0, F.col("source")).alias("source"), "size", "source_size",
                      "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))
