"""Bring legacy dictionaries into the id rules (S08, S09 with D4, D5, D6).

Old dictionary files may hold one key under several ids (pages were
renumbered every run) and one id for several keys (ids were reused after a
text sort). Each key keeps its lowest id; a key whose id is already held by
a smaller key of the same data centre gets a fresh id after the highest
one, in key order, through the same distributed numbering as new keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ids import assign_ids, highest_ids


def settle_ids(dim: DataFrame, key_cols: list[str], id_col: str, taken: DataFrame | None = None) -> DataFrame:
    """One row per key with ids unique per data centre (``dc`` in ``key_cols``).

    ``taken`` is a dictionary whose ids are in use (it holds none of the
    keys): a key with such an id gets a fresh one too.
    """
    rows = dim.where(F.col(id_col).isNotNull())
    per_key = rows.groupBy(*key_cols).agg(F.min(id_col).alias(id_col),
                                           F.min("batch_id").alias("batch_id"))
    # Ties on an id are few (one per re-use); the window groups are that small.
    holder = Window.partitionBy("dc", id_col).orderBy(*[k for k in key_cols if k != "dc"])
    ranked = per_key.withColumn("_first", F.row_number().over(holder) == 1)
    if taken is not None:
        used = taken.select("dc", id_col).distinct().withColumn("_used", F.lit(True))
        ranked = (ranked.join(used, ["dc", id_col], "left")
                  .withColumn("_first", F.col("_first") & F.col("_used").isNull()).drop("_used"))
    ranked = ranked.checkpoint(eager=True)
    keep = ranked.where("_first").drop("_first")
    clash = ranked.where(~F.col("_first")).drop("_first", id_col)
    ids = keep.select("dc", id_col) if taken is None else keep.select("dc", id_col).unionByName(taken.select("dc", id_col))
    fresh = assign_ids(clash, key_cols, id_col, highest_ids(ids, id_col))
    return keep.unionByName(fresh)
