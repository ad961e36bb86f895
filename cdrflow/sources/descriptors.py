"""Format descriptors: read, parse and flatten.

A descriptor is a small properties file named like
``data_format-<x>-<op>-<y>.properties``; its ``fields`` key holds a JSON
list of ``{name, type, format}``. Each descriptor becomes one row of the
format catalog; its fields are numbered by their place in the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.text import operator_from_name
from .landing import datatype_of, dc_of, place_of
from ..functions.time import VALID_PATTERN, epoch_from_text
from ..schema import (EPOCH_TARGET, DEFAULT_DELIMITER, DESCRIPTOR_FIELDS_SCHEMA, FORMAT_DELIMITER_KEY,
                      FORMAT_FIELDS_KEY, FORMAT_FILE_PATTERN, FORMAT_START_KEY,
                      FORMAT_START_PATTERN, LINE_FIELDS, URL_PATTERN)

# Keys and lines: plain characters with backslash escapes, written as unrolled loops
# (a repeated alternation recurses once per character in Java's regex engine).
_KEY_VALUE = r"(?s)^[ \t\f]*([^=: \t\f\\]*(?:\\.[^=: \t\f\\]*)*)[ \t\f]*[=:]?[ \t\f]*(.*)$"
# A logical line: a comment, or text in which an escaped line end doesn't end it.
_LINES = r"(?m)^[ \t\f]*+(?:[#!][^\r\n]*+|[^\r\n\\]*+(?:\\(?:\r\n|[\s\S])[^\r\n\\]*+)*+)"
# Its parts: a continuation, a code point, another escape, or plain text.
_PARTS = r"\\(?:\r\n|\r|\n)[ \t\f]*+|\\u[0-9a-fA-F]{4}|\\[^\r\n]|[^\\]++"


def read_descriptors(spark: SparkSession, root: str, registered_at: int) -> DataFrame:
    """Descriptor files under ``root/<dc>/<datatype>/`` as (dc, datatype, file_name, content).
    A folder that isn't there has none."""
    try:
        raw = (spark.read
               .option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.properties")
               .text(root, wholetext=True)
               .select(F.col("value").alias("content"),
                       F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_name").alias("file_name")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], "content string, path string, file_name string")
    return (raw
            .withColumn("_place", place_of(F.col("path"), root))
            .withColumn("dc", F.regexp_replace(dc_of(F.col("_place")), "^dc=", ""))
            .withColumn("datatype", F.regexp_replace(datatype_of(F.col("_place")), "^datatype=", ""))
            .drop("_place")
            .withColumn("registered_at", F.lit(registered_at).cast("bigint"))
            .drop("path"))


def _parts(text: Column, each) -> Column:
    """``text`` with ``each`` applied to its parts, in one pass from left to right."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0)), each), "")


def _unescape(value: Column) -> Column:
    r"""Properties escapes: ``\uXXXX``, ``\t \n \r \f`` and ``\x`` for any other x.
    What an escape gives is never read as one again; a last backslash stands alone and goes."""
    def plain(p: Column) -> Column:
        letter = F.substr(p, F.lit(2))
        return (F.when(~p.startswith("\\"), p)
                .when(F.length(p) == 6, F.decode(F.unhex(F.substr(p, F.lit(3))), "UTF-16BE"))
                .when(letter == "t", "\t").when(letter == "n", "\n").when(letter == "r", "\r").when(letter == "f", "\f")
                .otherwise(letter))
    return _parts(value, plain)


def _keep_last(entries: Column, key: str) -> Column:
    """Entries whose ``key`` does not occur again later in the array."""
    return F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(1))),
        lambda x: x[key] == e[key]) | (i + 1 == F.size(entries)))


def property_entries(content: Column) -> Column:
    """Properties text to an array of (key, value) in file order."""
    lines = F.regexp_extract_all(content, F.lit(_LINES), F.lit(0))
    kept = F.filter(lines, lambda l: l.rlike(r"^[ \t\f]*[^ \t\f#!]"))
    # A continued line goes on behind the next one's leading blanks.
    whole = F.transform(kept, lambda l: _parts(l, lambda p: F.when(p.rlike(r"^\\[\r\n]"), "").otherwise(p)))
    return F.transform(whole, lambda l: F.struct(
        _unescape(F.regexp_extract(l, _KEY_VALUE, 1)).alias("key"),
        _unescape(F.regexp_extract(l, _KEY_VALUE, 2)).alias("value")))


def parse_properties(content: Column) -> Column:
    """Properties text to ``map<string,string>``; the last value of a key wins."""
    return F.map_from_entries(_keep_last(property_entries(content), "key"))


def _by_name(fields: Column) -> Column:
    """(pos, type, format) by name. A field named twice keeps its last place, as a re-set
    property would."""
    named = F.filter(_keep_last(fields, "name"), lambda f: f["name"].isNotNull())
    return F.map_from_entries(F.transform(named, lambda f: F.struct(
        f["name"], F.struct(f["pos"].alias("pos"), f["type"].alias("type"),
                            f["format"].alias("format")))))


def _layout(by_name: Column) -> Column:
    """One struct member per target field: (pos, type, format), NULL when absent."""
    members = []
    for name in LINE_FIELDS:
        meta = F.try_element_at(by_name, F.lit(name))
        if name == "action_url":
            meta = F.when(meta.isNotNull(), F.struct(meta["pos"].alias("pos"), meta["type"].alias("type"),
                                                     F.lit(URL_PATTERN).alias("format")))
        members.append(meta.alias(name))
    return F.struct(*members)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus ``columns``, worked out once a row: they come from a generator of one
    row, whereas a plain projection would be copied into whatever names them, filters too."""
    made = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_made"))
    return made.select(*df.columns, *[F.col("_made")[n].alias(n) for n in columns])


def parse_descriptors(desc: DataFrame) -> DataFrame:
    """Parsed descriptors, one row each, with a ``problem`` column (NULL when valid).

    Input columns: dc, datatype, file_name, content, registered_at (and any others,
    which are kept). Each step is worked out once per descriptor (:func:`_once`).
    """
    keep = [c for c in desc.columns if c != "content"]
    entries = _once(desc, _entries=property_entries(F.col("content"))).drop("content")
    props = _once(entries, props=F.map_from_entries(_keep_last(F.col("_entries"), "key"))).drop("_entries")
    p = F.col("props")
    parsed = F.from_json(p[FORMAT_FIELDS_KEY], DESCRIPTOR_FIELDS_SCHEMA)
    numbered = F.transform(parsed["fields"], lambda f, i: F.struct(
        f["name"].alias("name"), i.cast("int").alias("pos"),
        F.upper(f["type"]).alias("type"), F.coalesce(f["format"], F.lit("")).alias("format")))
    tz = F.coalesce(p["timezone"], F.lit("UTC"))
    op = operator_from_name(F.col("file_name"), FORMAT_FILE_PATTERN)
    step1 = _once(
        props, op=op, timezone=tz,
        start_time=epoch_from_text(p[FORMAT_START_KEY], FORMAT_START_PATTERN, tz),
        delimiter=F.when(F.length(p[FORMAT_DELIMITER_KEY]) > 0, p[FORMAT_DELIMITER_KEY])
        .otherwise(F.lit(DEFAULT_DELIMITER)),
        field_list=numbered,
        format_name=F.col("file_name"),
        format_id=F.concat_ws("/", F.col("dc"), F.col("datatype"), op, F.col("file_name"),
                              F.col("registered_at").cast("string")),
        platform_name=p["platform_name"],
        platform_format_version=p["platform_format_version"])
    # Only the session time's pattern is ever read as one, and only where it is text.
    bad_pattern = F.exists("field_list", lambda f: (f["name"] == EPOCH_TARGET) & ~f["type"].isin("INT", "LONG")
                           & ~f["format"].rlike(VALID_PATTERN))
    placed = _once(_once(step1, _by_name=_by_name(F.col("field_list"))), layout=_layout(F.col("_by_name")))
    problem = (F.when(F.col("op").isNull(), F.lit("bad_descriptor_name"))
               .when(F.col("props")[FORMAT_START_KEY].isNull(), F.lit("no_start_time"))
               .when(F.col("start_time").isNull(), F.lit("bad_start_time"))
               .when(F.col("field_list").isNull() | (F.size("field_list") == 0), F.lit("no_fields"))
               .when(F.col("layout.session_time").isNull(), F.lit("no_session_time"))
               .when(bad_pattern, F.lit("bad_pattern")))
    out = _once(placed, field_names=F.transform("field_list", lambda f: f["name"]), problem=problem)
    return out.select(*[c for c in step1.columns if c != "props"], "field_names", "layout", "problem")


def format_fields(formats: DataFrame) -> DataFrame:
    """Flattened layout: one row per (format, field) with its place in the line."""
    return (formats
            .select("format_id", "dc", "datatype", "op",
                    F.posexplode("field_list").alias("n", "f"))
            .select("format_id", "dc", "datatype", "op",
                    F.col("f.name").alias("field"), F.col("f.pos").alias("pos"),
                    F.col("f.type").alias("type"),
                    F.when(F.col("f.name") == "action_url", F.lit(URL_PATTERN))
                    .otherwise(F.col("f.format")).alias("format")))
