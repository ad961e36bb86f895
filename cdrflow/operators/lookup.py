"""Lookups in a dictionary that is kept in layers.

A dictionary too large to broadcast is a ``base``, bucketed and sorted by one
text key, and the ``recent`` rows of later commits, which are few. Facts are
looked up in both: the recent rows are broadcast, and the base is joined bucket
by bucket, so only the facts are shuffled, into the base's buckets. Facts with a
hot key don't reach that shuffle: at most a thousand keys can be hot, and their
dictionary rows are broadcast as well. Facts without a key are spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins

KEY = "_key"
#: Parts over which facts that must not match are dealt.
SPREAD = 4096


@dataclass(frozen=True)
class Layers:
    """A dictionary: all its ``rows``; or, of the same rows, a ``base`` with the
    column ``_key`` by which it is bucketed, and the ``recent`` rest."""

    rows: DataFrame
    base: DataFrame | None = None
    recent: DataFrame | None = None


def key_text(keys: list[str]) -> Column:
    """One text per combination of ``keys``, nulls as '': lengths, then values."""
    values = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.concat(F.concat_ws(",", *[F.length(v).cast("string") for v in values]), F.lit(":"), *values)


def _spread_key(columns: list[str]) -> Column:
    """A text that is no key, dealt by the whole row."""
    return F.concat(F.lit("-"), F.pmod(F.xxhash64(*columns), F.lit(SPREAD)).cast("string"))


def with_value(facts: DataFrame, dim: DataFrame | Layers, keys: list[str], value: str) -> DataFrame:
    """``facts`` plus the dictionary's ``value`` of their ``keys``, null where there is none.

    Facts with a null key find nothing. Whatever the layers, the result is the same.
    """
    if isinstance(dim, DataFrame):
        return joins.lookup_join(facts, dim.select(*keys, value), keys, "left")
    held = dim.rows.select(*keys, value)
    small = joins.fits_broadcast(held)
    if small or dim.base is None:
        return joins.lookup_join(facts, held, keys, "left", small=small)
    columns = facts.columns
    hot = joins.hot_keys(facts, keys)
    near = (held.join(F.broadcast(hot), keys, "left_semi").withColumn("_hot", F.lit(True))
            .unionByName(dim.recent.select(*keys, value).join(F.broadcast(hot), keys, "left_anti").withColumn("_hot", F.lit(True))))
    found = facts.join(F.broadcast(near.withColumnRenamed(value, "_near")), keys, "left")
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    own = F.when(no_key | F.col("_hot"), _spread_key(columns)).otherwise(key_text(keys))
    base = dim.base.select(KEY, F.col(value).alias("_far"))
    return (found.withColumn(KEY, own).join(base, KEY, "left")
            .select(*columns, F.coalesce("_near", "_far").alias(value)))


def unknown(keys: DataFrame, dim: DataFrame | Layers, names: list[str]) -> DataFrame:
    """Rows of ``keys``, distinct and without nulls, that the dictionary doesn't hold.

    Next to a base only ``keys`` are shuffled.
    """
    if isinstance(dim, DataFrame):
        return joins.anti_join(keys, dim, names)
    if dim.base is None or joins.fits_broadcast(dim.rows.select(*names)):
        return joins.anti_join(keys, dim.rows, names)
    left = keys.join(F.broadcast(dim.recent.select(*names)), names, "left_anti")
    return left.withColumn(KEY, key_text(names)).join(dim.base.select(KEY), KEY, "left_anti").drop(KEY)
