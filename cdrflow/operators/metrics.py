"""Usage counts.

Both are plain hash aggregations: partial counts are taken in each task
before the shuffle, so a hot page or bucket costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import bucket_label, bucket_start


def page_hits(rows: DataFrame, by: str = "url") -> DataFrame:
    """Hits per page (A05): ``by='url'`` on standard rows, ``'page_id'`` on enriched rows."""
    if by == "url":
        # explode_outer and a filter behind it: the filter that explode implies
        # would extract the pages a second time, below.
        hits = rows.select("dc", F.explode_outer("urls").alias(by)).where(F.col(by).isNotNull())
    else:
        hits = rows.select("dc", F.explode("page_ids").alias(by))
    return (hits.groupBy("dc", by).agg(F.count(F.lit(1)).alias("hits")))


def bucket_counts(std: DataFrame, keys: list[str] | None = None,
                  pattern: str = "yyyy-MM-dd HH") -> DataFrame:
    """Rows per key and time bucket (A04); the bucket is the UTC time as ``pattern`` text."""
    keys = keys if keys is not None else ["dc", "op", "service_code", "bearer"]
    return (std.withColumn("bucket", bucket_label(F.col("session_time"), pattern))
            .groupBy(*keys, "bucket")
            .agg(F.count(F.lit(1)).alias("sessions"),
                 F.sum(F.col("duration").try_cast("bigint")).alias("duration"),
                 F.sum(F.col("page_sent").try_cast("bigint")).alias("pages")))


def window_counts(std: DataFrame, seconds: int = 3600, keys: list[str] | None = None) -> DataFrame:
    """Rows per key and fixed-size window, keyed by window start in epoch seconds."""
    keys = keys if keys is not None else ["dc", "op"]
    return (std.withColumn("window_start", bucket_start(F.col("session_time"), seconds))
            .groupBy(*keys, "window_start").agg(F.count(F.lit(1)).alias("sessions")))
