"""Format catalog: register descriptors, load versions.

A descriptor file is registered when its content differs from its last
registration: re-reading an unchanged file adds nothing, a changed file (also
one that goes back to an earlier content) becomes a new version with a newer
registration time, which wins ties on start time. Refused descriptors are
kept, once per content, with what is wrong with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import versions_per_operator
from ..operators.joins import anti_join
from .descriptors import format_fields, parse_descriptors, read_descriptors
from .tables import Warehouse, append, read_table

_FILE = ["dc", "datatype", "format_name"]
_IDENTITY = [*_FILE, "content_hash"]


def _last_contents(known: DataFrame) -> DataFrame:
    return (known.groupBy(*_FILE).agg(F.max_by("content_hash", "registered_at").alias("content_hash"))
            .select(*_IDENTITY))


def register(spark: SparkSession, root: str, wh: Warehouse, registered_at: int) -> DataFrame:
    """Parse the descriptors under ``root`` and append new ones to the catalog.

    ``registered_at`` is the run's clock in milliseconds. Returns every
    descriptor read with its ``problem`` (NULL when accepted).
    """
    desc = read_descriptors(spark, root, registered_at).withColumn(
        "content_hash", F.sha2(F.col("content"), 256))
    parsed = parse_descriptors(desc).checkpoint(eager=True)
    fresh = parsed.where(F.col("problem").isNull()).drop("problem")
    known = read_table(spark, wh.formats)
    if known is not None:
        fresh = anti_join(fresh, _last_contents(known), _IDENTITY)
    fresh = fresh.checkpoint(eager=True)
    if not fresh.isEmpty():
        append(fresh, wh.formats, ["dc", "datatype"])
        # the flattened layout, one row per (format, field): name, place, type, pattern
        append(format_fields(fresh), wh.format_fields, ["dc", "datatype"])
    refused = parsed.where(F.col("problem").isNotNull()).select(*_IDENTITY, "problem", "registered_at")
    before = read_table(spark, wh.format_problems)
    if before is not None:
        refused = anti_join(refused, before.select(*_IDENTITY).distinct(), _IDENTITY)
    refused = refused.checkpoint(eager=True)
    if not refused.isEmpty():
        append(refused, wh.format_problems, ["dc", "datatype"])
    return parsed


def formats(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """All registered format versions."""
    df = read_table(spark, wh.formats)
    if df is None:
        raise FileNotFoundError(f"no format catalog at {wh.formats}")
    return df.withColumn("problem", F.lit(None).cast("string"))


def versions(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Versions grouped per (dc, datatype, op), oldest first."""
    return versions_per_operator(formats(spark, wh))
