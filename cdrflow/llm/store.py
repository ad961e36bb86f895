"""Tables written to the shared scratch folder, and size-checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.session import scratch_path

#: A key set of at most so many rows (of two longs) is broadcast.
BROADCAST_ROWS = 1_000_000


#: Rows and bytes of an Arrow batch, whichever is reached first: documents have kilobytes, some of them megabytes.
BATCH_ROWS, BATCH_BYTES = 2_000, 4_000_000
_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches. A limit that the cluster's configuration names stays."""
    for name, most in _LIMITS.items():
        if not spark.sparkContext.getConf().contains(name):
            spark.conf.set(name, str(most))


#: Fixed thresholds: without them the allocator keeps what a worker's largest arrays once took, stage after stage.
LEAN = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(spark: SparkSession) -> None:
    """Have Python workers give freed arrays back to the system, and bound their batches. Names that are set already stay."""
    bounded_batches(spark)
    for name, value in LEAN.items():
        spark.sparkContext.environment.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts, read in bounded Arrow batches."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet under spark.checkpoint.dir, with the writer's ``options``, and read
    back: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, weight: str | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it is counted to be within ``most`` rows.

    Only for stored tables of a few numeric columns. With an array column, its
    size is the ``weight`` of a row (an SQL expression), so that the bound
    holds for the numbers broadcast.
    """
    n = df.count() if weight is None else (df.selectExpr(f"sum(1 + {weight})").first()[0] or 0)
    return F.broadcast(df) if n <= most else df
