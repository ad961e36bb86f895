"""Connected components by alternating large-star and small-star.

Both steps are joins and aggregations over the edge list, so a node with a
third of all edges is pre-aggregated to one row per task and its join is
split by adaptive execution. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

#: Edges within one file-sized piece of work need no more tasks than this.
EDGES_PER_TASK = 200_000


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. ``edges`` (u, v) hold each edge once, with u > v."""
    if large:  # each larger neighbour of u goes to the smallest of u and its neighbours
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # u and each smaller neighbour go to the smallest neighbour
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u")
                 .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs).

    The component is the smallest node reachable. Loops, repeated edges and
    edges in both directions are fine; rows with a null end are ignored. An
    empty edge list gives an empty table.
    """
    now = (edges.filter("a <> b")
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = stored(now, f"{name}-edges")
    before, round_ = _digest(now), 0
    while before[0]:
        round_ += 1
        now = stored(_star(_star(now, True), False), f"{name}-round{round_}")
        after = _digest(now)
        if after == before:
            break
        before = after
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(now.select(F.col("v"), F.col("v")).distinct()))
