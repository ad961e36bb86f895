"""Lookup joins against dimension-like tables.

A dimension is broadcast only when its row count has been checked to be
under a bound. Above the bound the join shuffles, once: rows of keys that
hold a large share of the facts (a hot page, a test subscriber) and rows
without a key are dealt over ``SALTS`` parts, and only the hot keys'
dimension rows are repeated in each. Both paths give the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Size of a dimension that may be broadcast to every task: both bounds hold.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Hot-key detection: sample share, the least share of rows, and the least rows
# in the sample. A key is hot at HOT_MIN_SHARE of all rows, and on a session with
# many shuffle partitions already at HOT_PART of a partition's mean share; see ``hot_share``.
HOT_SAMPLE_FRACTION = 0.01
HOT_MIN_SHARE = 0.001
HOT_PART = 0.5
HOT_MOST = 100_000     # hot keys at most: no share under 1 / HOT_MOST counts
HOT_MIN_ROWS = 20
SALTS = 64


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of ``df``, measured in one aggregation.

    Strings count their bytes, nested values the length of their JSON form,
    other fields 8 bytes.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    size = sum(parts, F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def within_bounds(rows: int, nbytes: int, max_rows: int | None = None,
                  max_bytes: int | None = None) -> bool:
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    return rows <= max_rows and nbytes <= max_bytes


def fits_broadcast(df: DataFrame, max_rows: int | None = None,
                   max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes``
    of data, both measured (not guessed from file sizes). The bytes are only
    summed where the rows, which a Parquet table counts in its footers, fit."""
    if not within_bounds(df.count(), 0, max_rows, max_bytes):
        return False
    return within_bounds(*measure(df), max_rows, max_bytes)


def hot_share(spark: SparkSession) -> float:
    """The share of all rows at which a key is hot: with many shuffle partitions a
    key far below HOT_MIN_SHARE can outweigh all else in its partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(HOT_MIN_SHARE, HOT_PART / partitions), 1 / HOT_MOST)


def hot_keys(facts: DataFrame, keys: list[str], fraction: float = HOT_SAMPLE_FRACTION,
             min_share: float | None = None) -> DataFrame:
    """Keys holding at least ``min_share`` of a sample of ``facts``, most rows first.

    At most 1 / ``min_share`` rows, from one pass; the result is checkpointed
    so every use sees the same set. Without ``min_share``, the session's ``hot_share``.
    """
    min_share = hot_share(facts.sparkSession) if min_share is None else min_share
    sample = facts.select(*keys).dropna(subset=keys).sample(fraction=fraction, seed=7)
    counts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    floor = max(HOT_MIN_ROWS, int(total * min_share))
    return counts.where(F.col("_n") >= floor).orderBy(F.desc("_n"), *keys).select(*keys).checkpoint(eager=True)


def lookup_join(facts: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                broadcast_max_rows: int | None = None, small: bool | None = None) -> DataFrame:
    """Join ``facts`` to ``dim`` on equal ``keys`` (``left``, ``inner``,
    ``left_semi`` or ``left_anti``), choosing the strategy by checked size.

    ``small`` is the caller's own :func:`fits_broadcast` verdict.
    """
    bound = BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    if small is None:
        small = fits_broadcast(dim, bound)
    if small:
        return facts.join(F.broadcast(dim), keys, how)
    # Which part a row goes to depends on the row alone: a retried task deals the same.
    columns = facts.columns
    part = F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    hot = F.broadcast(hot_keys(facts, keys).withColumn("_hot", F.lit(True)))
    dealt = (facts.join(hot, keys, "left")
             .withColumn("_part", F.when(no_key | F.col("_hot"), part).otherwise(F.lit(0))).drop("_hot"))
    held = (dim.join(hot, keys, "left")
            .withColumn("_part", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                           .otherwise(F.array(F.lit(0))))).drop("_hot"))
    joined = dealt.join(held, [*keys, "_part"], how)
    rest = [c for c in columns if c not in keys]
    return joined.select(*keys, *rest, *([] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c not in keys]))


def anti_join(df: DataFrame, dim: DataFrame, keys: list[str],
              broadcast_max_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``dim`` (set difference on keys).

    The small side decides: a small ``dim`` is broadcast; of a large one a
    small ``df`` first picks the keys it needs, so a batch of a few files
    doesn't shuffle the whole dictionary. Else both sides shuffle; the keys
    of ``df`` are expected to be distinct, so none is hot.
    """
    bound = BROADCAST_MAX_ROWS if broadcast_max_rows is None else broadcast_max_rows
    held = dim.select(*keys)
    if fits_broadcast(held, bound):
        return df.join(F.broadcast(held), keys, "left_anti")
    own = df.select(*keys)
    if fits_broadcast(own, bound):
        known = held.join(F.broadcast(own), keys, "left_semi").distinct().checkpoint(eager=True)
        return df.join(F.broadcast(known), keys, "left_anti")  # no more rows than df has
    return df.join(held, keys, "left_anti")
