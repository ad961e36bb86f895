"""Column functions for delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import URL_PATTERN

_INTEGER_TEXT = r"^[+-]?[0-9]+$"


def quote_regex(delimiter: Column | str) -> Column:
    """Escape a literal delimiter so that ``split`` treats it as text."""
    d = F.lit(delimiter) if isinstance(delimiter, str) else delimiter
    return F.regexp_replace(d, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def split_line(line: Column, delimiter_rx: Column | str) -> Column:
    """All fields of a line; trailing empty fields are kept."""
    rx = F.lit(delimiter_rx) if isinstance(delimiter_rx, str) else delimiter_rx
    return F.split(line, rx, -1)


def field_at(parts: Column, pos: Column | int) -> Column:
    """Field at 0-based position; NULL when the line is too short."""
    p = F.lit(pos) if isinstance(pos, int) else pos
    return F.get(parts, p)


def parse_int(text: Column) -> Column:
    """Whole-number text to int; anything else, or overflow, is NULL."""
    return F.when(text.rlike(_INTEGER_TEXT), text.try_cast("int"))


def parse_long(text: Column) -> Column:
    """Whole-number text to bigint; anything else, or overflow, is NULL."""
    return F.when(text.rlike(_INTEGER_TEXT), text.try_cast("bigint"))


def extract_urls(text: Column, pattern: Column | str = URL_PATTERN) -> Column:
    """All page URLs of an ``action_url`` value, in order, duplicates kept."""
    rx = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(text, rx, 0))


def operator_from_name(name: Column, pattern: str) -> Column:
    """First group of ``pattern`` in a file name; NULL when it does not match."""
    op = F.regexp_extract(name, pattern, 1)
    return F.when(op != "", op)


def join_fields(*cols: Column, sep: str = ";") -> Column:
    """Text row with missing values as empty fields."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
