"""Format choice per row: an as-of lookup.

Each operator has a few format versions, each valid from its start time.
A row takes the version with the latest start not after the row's session
time. The session time itself is read through each candidate version
(its delimiter, position, type and pattern), so a row written in an old
layout never qualifies under a new one.

Spark has no as-of join, and a range join per row would multiply rows.
Instead the catalog is grouped to one row per operator holding its
versions sorted by start; that small table is joined (broadcast after a
size check) and a higher-order function walks the versions newest first
and keeps the first that qualifies. Fact rows are never shuffled.

With many versions the walk gives way to a search: versions that read the time
alike are one reading, the line's time is read once per reading, and the latest
start until it is found by halving (:func:`with_ranked_version`).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import field_at, parse_long, quote_regex, split_line
from ..functions.time import epoch_by_rule, plausible_epoch, time_rule
from ..session import built_once
from .joins import fits_broadcast, lookup_join
from .staging import staged

OP_KEY = ["dc", "datatype", "op"]


def versions_per_operator(formats: DataFrame) -> DataFrame:
    """One row per (dc, datatype, op) with its valid versions, oldest first.

    Ties on start time go to the newest registration, then the name. What a
    line's time needs of a version (``rule``) is worked out here, once.
    """
    meta = F.col("layout.session_time")
    version = F.struct(
        F.col("start_time"), F.col("registered_at"), F.col("format_name"),
        F.col("format_id"), F.col("delimiter"),
        quote_regex(F.col("delimiter")).alias("delim_rx"),
        F.col("timezone"), F.col("layout"),
        meta["type"].isin("INT", "LONG").alias("numeric_time"),
        time_rule(meta["format"], F.col("timezone")).alias("rule"))
    return (formats.where(F.col("problem").isNull())
            .groupBy(*OP_KEY)
            .agg(F.sort_array(F.collect_list(version)).alias("versions")))


def time_under(line: Column, version: Column, pos: Column | None = None) -> Column:
    """Session time (epoch seconds) of ``line`` read through ``version``; NULL where
    no time stands, or one beyond the years 1 to 9999."""
    raw = field_at(split_line(line, version["delim_rx"]), version["layout"]["session_time"]["pos"] if pos is None else pos)
    return F.when(version["numeric_time"], plausible_epoch(parse_long(raw))).otherwise(plausible_epoch(epoch_by_rule(raw, version["rule"])))


def choose_version(line: Column, versions: Column, element_type: T.DataType) -> Column:
    """Struct (time, version) of the version valid for ``line``: latest start not
    after the line's time under it, else NULL.

    Versions are tried newest first; once one fits, older ones are not read.
    The lambda keeps the compiled stage small however many versions exist
    (an unrolled CASE, pushed into filters by the optimizer, outgrows the
    JVM's method size limit).
    """
    kind = T.StructType([T.StructField("time", T.LongType()), T.StructField("version", element_type)])

    def tried(v: Column) -> Column:
        fits = F.filter(F.array(time_under(line, v)), lambda t: t >= v["start_time"])
        return F.get(F.transform(fits, lambda t: F.struct(t.alias("time"), v.alias("version"))), 0)

    return F.aggregate(F.reverse(versions), F.lit(None).cast(kind),
                       lambda acc, v: F.when(acc.isNotNull(), acc).otherwise(tried(v)))


@built_once
def _choice(line: str, versions: str, element_type: str) -> Column:
    kind = T.StructType.fromJson(json.loads(element_type))
    return F.explode(F.array(choose_version(F.col(line), F.col(versions), kind))).alias("_choice")


def with_chosen_version(df: DataFrame, line: str = "line", versions: str = "versions",
                        out: str = "_v") -> DataFrame:
    """``df`` plus ``out``, the version valid for each line, and ``out + '_time'``,
    its session time under it (NULL when none is).

    The choice is made by a generator of one row: later filters and
    projections refer to its result, whereas a plain projection would be
    copied into each of them and walk the versions again.
    """
    made = df.select("*", _choice(line, versions, df.schema[versions].dataType.elementType.json()))
    return made.select("*", F.col("_choice.version").alias(out), F.col("_choice.time").alias(f"{out}_time")).drop("_choice")


# Many versions: ways of reading the time, and versions by rank ----------------

def ranked_versions(formats: DataFrame) -> DataFrame:
    """Valid versions (dc, datatype, op, ``_rank``, ``_v``), ranked per operator by start,
    then registration, then name: of those that fit a line the highest holds."""
    order = Window.partitionBy(*OP_KEY).orderBy("start_time", "registered_at", "format_name", "format_id")
    version = F.struct("format_name", "format_id", quote_regex(F.col("delimiter")).alias("delim_rx"), "layout")
    return (formats.where(F.col("problem").isNull())
            .select(*OP_KEY, "start_time", "timezone", F.row_number().over(order).alias("_rank"), version.alias("_v")))


def readings_per_operator(ranked: DataFrame) -> DataFrame:
    """One row per operator: the distinct ways (delimiter, place, type, pattern, zone)
    in which its versions read the time, each with its versions' ``starts`` in
    order and their ``ranks``. Hundreds of versions have a few ways."""
    meta = F.col("_v.layout.session_time")
    way = F.struct(F.col("_v.delim_rx").alias("delim_rx"), meta["pos"].alias("pos"), meta["type"].isin("INT", "LONG").alias("numeric_time"),
                   time_rule(meta["format"], F.col("timezone")).alias("rule"))
    per_start = ranked.groupBy(*OP_KEY, way.alias("way"), "start_time").agg(F.max("_rank").alias("rank"))
    places = F.sort_array(F.collect_list(F.struct("start_time", "rank")))
    per_way = per_start.groupBy(*OP_KEY, "way").agg(places.alias("p")).select(
        *OP_KEY, F.struct("way.*", F.transform("p", lambda x: x["start_time"]).alias("starts"),
                          F.transform("p", lambda x: x["rank"]).alias("ranks")).alias("reading"))
    return per_way.groupBy(*OP_KEY).agg(F.collect_list("reading").alias("versions"))


def starts_until(starts: Column, time: Column) -> Column:
    """How many of the sorted ``starts`` aren't after ``time``, by halving."""
    def half(a: Column, _) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        after = F.get(starts, mid) > time
        return (F.when(a["lo"] >= a["hi"], a)
                .when(after, F.struct(a["lo"].alias("lo"), mid.alias("hi")))
                .otherwise(F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))))
    first = F.struct(F.lit(0).alias("lo"), F.size(starts).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(starts).cast("long")))), first, half)["lo"]


@built_once
def _ranked_choice() -> Column:
    """(time, rank) of the version that holds: per reading the time once, then the
    latest start until it; of all readings the highest rank."""
    def better(best: Column, reading: Column) -> Column:
        def found(t: Column) -> Column:
            rank = F.get(reading["ranks"], starts_until(reading["starts"], t) - 1)
            return F.when(t.isNotNull() & (t >= F.get(reading["starts"], F.lit(0))), F.struct(t.alias("time"), rank.alias("rank")))
        tried = F.get(F.transform(F.array(time_under(F.col("line"), reading, reading["pos"])), found), 0)
        return F.get(F.transform(F.array(tried), lambda x: F.when(x.isNull() | (best["rank"] > x["rank"]), best).otherwise(x)), 0)
    none = F.lit(None).cast("struct<time: bigint, rank: int>")
    return F.explode(F.array(F.aggregate("versions", none, better))).alias("_choice")


def with_ranked_version(lines: DataFrame, formats: DataFrame) -> DataFrame:
    """``lines`` plus ``versions`` (NULL for an unknown operator), ``_v`` and ``_v_time``, as
    :func:`with_chosen_version` gives them, for any number of versions.

    A line carries its operator's starts, 12 bytes a version, and the few ways of
    reading its time; the chosen version is then looked up by its rank. Both
    tables are broadcast only within their measured bounds.
    """
    ranked = staged(ranked_versions(formats), "ranked-versions")
    readings = staged(readings_per_operator(ranked), "readings")
    chosen = lookup_join(lines, readings, OP_KEY, "left", small=fits_broadcast(readings)).select("*", _ranked_choice())
    chosen = chosen.select("*", F.col("_choice.rank").alias("_rank"), F.col("_choice.time").alias("_v_time")).drop("_choice")
    held = ranked.select(*OP_KEY, "_rank", "_v")
    return lookup_join(chosen, held, [*OP_KEY, "_rank"], "left", small=fits_broadcast(held)).drop("_rank")


def catalog_fits(versions: DataFrame) -> bool:
    """Whether the grouped catalog may be broadcast (rows and bytes measured)."""
    return fits_broadcast(versions)


def attach_versions(lines: DataFrame, versions: DataFrame, small: bool | None = None) -> DataFrame:
    """Left-join each line to its operator's versions: broadcast when the
    catalog's measured size allows, else a shuffle join."""
    return lookup_join(lines, versions, OP_KEY, "left", small=small)
