"""Time functions.

Times are kept as epoch seconds (``bigint``) next to a ``timestamp``.
Wall-clock text is always parsed with an explicit zone, so results do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# The letters, and how often each may stand in a row, that
# Spark's parser takes when it reads a time. Anything else is refused when a
# format is registered, because an illegal pattern fails a whole job. Week
# fields, quarters' names and optional sections are not taken.
_PATTERN_RUNS = ["y{1,6}", "M{1,4}", "L{1,4}", "d{1,2}", "D{1,3}", "H{1,2}", "h{1,2}", "k{1,2}", "K{1,2}",
                 "m{1,2}", "s{1,2}", "S{1,9}", "a", "VV", "z{1,4}", "O", "O{4}", "X{1,5}", "x{1,5}", "Z{1,5}"]
_RUN = "|".join(f"(?<!{r[0]}){r}(?!{r[0]})" for r in _PATTERN_RUNS)
_OTHER = r"[^A-Za-z'\[\]{}#]"
# Characters that stand for themselves in a pattern.
_MARK = r"[ !\"$%&()*+,\-./0-9:;<=>?@\\^_`|~]"
VALID_PATTERN = rf"^(?:{_RUN}|{_OTHER}|'[^']*')*$"


def _lit(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def epoch_from_text(text: Column, pattern: Column | str, zone: Column | str = "UTC") -> Column:
    """Epoch seconds of wall-clock text read with ``pattern`` in ``zone``.

    A pattern with its own zone or offset letters is read as it is; otherwise
    ``zone`` is attached. NULL for unparsable text or a blank pattern.
    """
    return epoch_by_rule(text, time_rule(_lit(pattern), _lit(zone)))


def time_rule(pattern: Column, zone: Column) -> Column:
    """What :func:`epoch_by_rule` needs of a pattern, worked out once per pattern:
    (whole, suffix, marks) -- the pattern with a zone, what is put behind the text, and
    the characters that a text must hold to be read at all. NULL for a blank pattern."""
    has_zone = F.regexp_replace(pattern, "'[^']*'", "").rlike("[zZXxVO]")
    plain = F.regexp_replace(pattern, "'[^']*'", "")
    marks = F.when(plain.rlike(r"[\[\]{}#']"), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.regexp_extract_all(plain, F.lit(_MARK), F.lit(0))))
    return F.when(F.trim(pattern) != "", F.struct(
        F.when(has_zone, pattern).otherwise(F.concat(pattern, F.lit(" VV"))).alias("whole"),
        F.when(has_zone, F.lit("")).otherwise(F.concat(F.lit(" "), zone)).alias("suffix"), marks.alias("marks")))


def epoch_by_rule(text: Column, rule: Column) -> Column:
    """Epoch seconds of text read by a :func:`time_rule`; NULL when either is missing.

    A text that lacks one of the pattern's marks can't be read and isn't tried: Spark's
    parser refuses by an exception, which costs more than a parse (a line's
    time is tried under versions that it wasn't written in)."""
    timed = F.concat(text, rule["suffix"])
    may = rule.isNotNull() & (F.trim(text) != "") & F.forall(rule["marks"], lambda m: F.contains(timed, m))
    return F.when(may, F.unix_seconds(F.try_to_timestamp(timed, rule["whole"])))


def epoch_from_ntz(ts: Column) -> Column:
    """Epoch seconds of a ``timestamp_ntz`` read as UTC wall time."""
    return F.unix_timestamp(ts)


def plausible_epoch(epoch_seconds: Column) -> Column:
    """Epoch seconds within the years 1 to 9999, else NULL: what a timestamp and its
    text can hold. Milliseconds or microseconds read as seconds lie outside."""
    return F.when(epoch_seconds.between(FIRST_SECOND, LAST_SECOND), epoch_seconds)


def to_timestamp(epoch_seconds: Column) -> Column:
    """Epoch seconds to a timestamp; NULL beyond the years 1 to 9999."""
    return F.timestamp_seconds(plausible_epoch(epoch_seconds))


def utc_wall_time(epoch_seconds: Column) -> Column:
    """Epoch seconds as a UTC ``timestamp_ntz`` (formatting it needs no zone); NULL
    beyond the years 1 to 9999."""
    return F.timestamp_add("SECOND", plausible_epoch(epoch_seconds), F.expr(_EPOCH_NTZ))


def bucket_label(epoch_seconds: Column, pattern: str = "yyyy-MM-dd HH") -> Column:
    """Text bucket of a time, in UTC, by a date pattern (F16)."""
    return F.date_format(utc_wall_time(epoch_seconds), pattern)


def bucket_start(epoch_seconds: Column, seconds: int = 3600) -> Column:
    """Start of the fixed-size bucket holding a time, in epoch seconds (F16)."""
    return F.floor(epoch_seconds / F.lit(seconds)).cast("bigint") * F.lit(seconds)
