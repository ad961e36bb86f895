"""Usage as a stream: sessions per window, kept up to date as lines arrive (A04 over T01).

Lines are parsed as in the batch job, in the stream. A record that arrives twice
within the delay counts once; a late one, within the delay, is added to its window;
one later than that is left out, as its window is closed. State is the windows
and records of the delay, spread by key; it survives a restart with the
checkpoint. Each trigger writes the windows it changed under its number, so a
trigger that is repeated replaces what it wrote; :func:`usage_now` takes each
window's newest row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.standardize import good_rows, parse_by_formats
from ..sources import tables
from ..sources.landing import tag_lines
from .arrival import MAX_FILES_PER_BATCH, arrival_lines

WINDOW_KEY = ["dc", "op", "window_start"]


def windowed(std: DataFrame, window: str, delay: str) -> DataFrame:
    """Sessions, seconds and pages per data centre, operator and window of a stream of
    standard rows with ``line``."""
    number = lambda c: F.col(c).try_cast("bigint")
    once = (std.where(F.col("session_ts").isNotNull()).withWatermark("session_ts", delay)
            .dropDuplicatesWithinWatermark(["dc", "op", "session_ts", "line"]))
    start: Column = F.unix_seconds(F.col("window.start")).alias("window_start")
    return (once.groupBy("dc", "op", F.window("session_ts", window))
            .agg(F.count(F.lit(1)).alias("sessions"), F.sum(number("duration")).alias("duration"), F.sum(number("page_sent")).alias("pages"))
            .select("dc", "op", start, "sessions", "duration", "pages"))


def start(spark: SparkSession, landing_root: str, formats: DataFrame, out: str, checkpoint: str,
          window: str = "15 minutes", delay: str = "1 day", available_now: bool = True, processing_time: str | None = None,
          max_files: int = MAX_FILES_PER_BATCH) -> StreamingQuery:
    """Start counting the lines arriving under ``landing_root``, read by the catalog ``formats``."""
    lines = tag_lines(arrival_lines(spark, landing_root, max_files), 0, landing_root, number=False)
    std = good_rows(parse_by_formats(lines, formats), "line")

    def each(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    writer = (windowed(std, window, delay).writeStream.outputMode("update").foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(spark: SparkSession, landing_root: str, formats: DataFrame, out: str, checkpoint: str, **options) -> None:
    """Count every file not yet seen by ``checkpoint``, then return."""
    q = start(spark, landing_root, formats, out, checkpoint, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def usage_now(spark: SparkSession, out: str) -> DataFrame | None:
    """The newest row of each window; None before the first trigger."""
    rows = tables.read_table(spark, out)
    if rows is None:
        return None
    newest = F.max_by(F.struct("sessions", "duration", "pages"), F.col("epoch").cast("bigint")).alias("u")
    return rows.groupBy(*WINDOW_KEY).agg(newest).select(*WINDOW_KEY, "u.*")
