"""Lines whose format version changes when descriptors arrive late.

A new version of an operator takes over from its start to the start of the next
version, and only lines of that operator can change. Where all its versions read
the time alike (delimiter, place, type, pattern, zone), a stored row's time is
its time under the new version too, so the difference of the two catalogs is
a set of intervals (operator, time), and good rows outside them stay as they
are. Where versions read the time in different ways, every row of the operator
may change. Rejected lines of the operator always may.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import OP_KEY
from .joins import fits_broadcast, lookup_join
from .staging import staged

FOREVER = (1 << 63) - 1


def takeovers(formats: DataFrame, before: int) -> DataFrame:
    """Per operator with versions registered after ``before``: the intervals
    ``times`` (first, last) of session times that they take over."""
    valid = formats.where(F.col("problem").isNull())
    order = Window.partitionBy(*OP_KEY).orderBy("start_time", "registered_at", "format_name")
    # At equal starts the newest registration holds; the others hold nothing.
    placed = valid.withColumn("_until", F.coalesce(F.lead("start_time").over(order) - 1, F.lit(FOREVER)))
    time = F.col("layout.session_time")
    reads = F.to_json(F.struct("delimiter", "timezone", time["pos"].alias("pos"), time["type"].alias("type"), time["format"].alias("format")))
    new = F.col("registered_at") > before
    return (placed.groupBy(*OP_KEY)
            .agg(F.count_distinct(reads).alias("_readings"),
                 F.collect_list(F.when(new, F.struct(F.col("start_time").alias("first"), F.col("_until").alias("last")))).alias("times"))
            .where(F.size("times") > 0)
            .withColumn("times", F.when(F.col("_readings") == 1, F.col("times")))
            .drop("_readings"))


def changed_lines(stored: DataFrame, formats: DataFrame, before: int) -> tuple[DataFrame, DataFrame] | None:
    """(lines to parse again, records that stay) of one batch's records, or None
    when no line may change. ``before`` is the newest registration it was parsed with."""
    new = staged(takeovers(formats, before), "takeovers")
    inside = F.col("times").isNull() | F.exists("times", lambda t: F.col("session_time").between(t["first"], t["last"]))
    known = new.withColumn("_new", F.lit(True))
    marked = lookup_join(stored, known, OP_KEY, "left", small=fits_broadcast(known))
    may = F.coalesce(F.col("_new"), F.lit(False)) & ((F.col("status") == "rejected") | inside)
    marked = marked.withColumn("_may", may)
    if marked.where("_may").isEmpty():
        return None
    tags = ["dc", "datatype", "batch_id", "op", "source_file", "row_id", "line"]
    return (marked.where("_may").select(*tags),
            marked.where(~F.coalesce(F.col("_may"), F.lit(False))).select(*stored.columns))
