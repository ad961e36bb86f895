"""Dense, deterministic ids for new keys.

Ids continue each data centre's highest id, in key order. A global
``row_number()`` over all keys would run in one task, and the first load
brings every key. Instead keys are range-partitioned and sorted, the
result is checkpointed (so partition numbers are stable under retries),
rows are counted per (partition, data centre), and each row's id is a base
taken from those counts plus its place in the partition. Only the count
table, bounded by partitions + data centres, is joined (broadcast after a
size check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup_join

_LOCAL_BITS = 33
#: New keys that one task may number.
SMALL_ROWS = 200_000


def highest_ids(dim: DataFrame, id_col: str, group_col: str = "dc") -> DataFrame:
    """Highest id per group, 0 for an empty dimension."""
    return dim.groupBy(group_col).agg(
        F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("_start"))


def _ranked(keys: DataFrame, order_cols: list[str], partitions: int | None) -> DataFrame:
    """Keys range-partitioned and sorted, with partition number and place in it.

    Checkpointed: partition numbers must not change between the counting
    pass and the numbering pass, even when a task is retried.
    """
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = (keys.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mono", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    return (ranked.withColumn("_part", F.shiftright("_mono", _LOCAL_BITS))
            .withColumn("_local", F.col("_mono").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
            .drop("_mono"))


def assign_ids(new_keys: DataFrame, key_cols: list[str], id_col: str,
               start: DataFrame, group_col: str = "dc", partitions: int | None = None,
               rows: int | None = None) -> DataFrame:
    """Give unique ``new_keys`` ids ``start[group] + 1, + 2, ...`` in key order.

    ``rows`` is the number of keys, where the caller knows it: up to
    ``SMALL_ROWS`` are numbered by one window over each group.

    ``start`` has ``group_col`` and ``_start`` (see :func:`highest_ids`).
    Keys are sorted by group first, so each range partition holds a run of
    whole or partial groups. From the row counts per (partition, group) --
    at most partitions + groups rows -- each pair gets a base:
    ``start + rows of the group in earlier partitions - rows of earlier
    groups in this partition``; a key's id is ``base + place in partition + 1``.
    """
    order = [group_col] + [k for k in key_cols if k != group_col]
    if rows is not None and rows <= SMALL_ROWS:
        place = F.row_number().over(Window.partitionBy(group_col).orderBy(*order[1:]))
        return (new_keys.withColumn("_place", place).join(F.broadcast(start), group_col, "left")
                .withColumn(id_col, (F.coalesce(F.col("_start"), F.lit(0)) + F.col("_place")).cast("bigint"))
                .drop("_place", "_start"))
    ranked = _ranked(new_keys, order, partitions)
    counts = ranked.groupBy("_part", group_col).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group_col).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    before = Window.partitionBy("_part").orderBy(group_col).rowsBetween(
        Window.unboundedPreceding, -1)
    bases = (counts
             .withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
                         - F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .join(start, group_col, "left")
             .select("_part", group_col,
                     (F.col("_base") + F.coalesce(F.col("_start"), F.lit(0))).alias("_base")))
    return (lookup_join(ranked, bases, ["_part", group_col], "inner")
            .withColumn(id_col, (F.col("_base") + F.col("_local") + 1).cast("bigint"))
            .drop("_part", "_local", "_base"))
