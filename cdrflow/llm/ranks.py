"""Places of rows in a total order, without a single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

#: Bits of monotonically_increasing_id that count rows within a partition.
ROW_BITS = 33


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place ``at`` (long, from 0) in the given order.

    ``df`` should be stored: it is read twice, once for the range bounds. Rows
    that are equal in ``order`` stand in one range partition, in any sequence,
    so end the order with something that tells rows apart. The number of range
    partitions bounds what comes to the driver: one count each.
    """
    spark = df.sparkSession
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_place", F.monotonically_increasing_id()), f"{name}-ranked")
    part = F.shiftright("_place", ROW_BITS)
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())
    before, starts = 0, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (rows.join(starts, part == F.col("_part"))
            .select(*df.columns, (F.col("_start") + inside).alias("at")))
