"""Parallelism guard for narrow inputs.

A scan of one small file or one row group gives one task; the CPU-heavy
parsing after it would then run on one core. When an input would leave
more than half of the cluster's cores idle, it is spread round-robin over
all of them (Spark sorts before a round-robin split, so a retried task gets
the same rows). Large inputs have far more splits than cores and are left
untouched: no shuffle is added to a big scan. A table of many small rows, each of
which makes much work, is a scan of few splits; with its number of rows given, it
is spread over tasks of ``TASK_ROWS``, so the longest doesn't grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


#: Rows that a task takes on where each makes much work.
TASK_ROWS = 200_000


def spread(df: DataFrame, min_partitions: int | None = None, rows: int = 0) -> DataFrame:
    target = max(min_partitions or df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    if df._jdf.queryExecution().toRdd().getNumPartitions() * 2 <= target:
        return df.repartition(target)
    return df
