"""Lines to standard rows, bad lines to quarantine.

Every target column is found by name in the chosen version and read by
position, typed by the version's declared type. A column the version
lacks is NULL; a source field the target lacks is dropped. Lines without
an operator, with an unknown operator or with no valid version are not
fatal: they are kept aside with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_urls, field_at, parse_int, parse_long, split_line
from ..functions.time import to_timestamp
from ..schema import EPOCH_TARGET, LINE_FIELDS, UNPLACED, URL_TARGET
from ..session import built_once
from .asof import OP_KEY, attach_versions, versions_per_operator, with_chosen_version, with_ranked_version

#: Versions of one operator that a line walks; more are searched.
MANY = 24

TAG_COLUMNS = ["dc", "datatype", "batch_id", "op", "source_file", "row_id"]

STD_COLUMNS = [
    "dc", "datatype", "batch_id", "op", "msisdn", "imsi", "imei", "subscription",
    "language", "session_time", "session_ts", "service_code", "bearer", "page_sent",
    "duration", "vlr_number", "session_end", "urls", "extra", "source_file", "row_id",
    "format_id", "format_name",
]

REJECT_COLUMNS = TAG_COLUMNS + ["line", "reason"]


def _typed(name: str, raw: Column, kind: Column) -> Column:
    """A field as its version declares it: INT and LONG values that are such
    numbers, other types as they are. All but the page list are kept as text."""
    if name == URL_TARGET:
        return extract_urls(raw)
    return (F.when(kind == "INT", parse_int(raw).cast("string"))
            .when(kind == "LONG", parse_long(raw).cast("string"))
            .otherwise(raw))


def parse_lines(lines: DataFrame, versions: DataFrame,
                small: bool | None = None, mode: str = "quarantine") -> DataFrame:
    """Standard columns plus ``reason`` (NULL when the line is good) and ``line``.

    ``lines`` has the tag columns and ``line``; ``small`` is the catalog's
    broadcast verdict (:func:`catalog_fits`) when already known. With
    ``mode='failfast'`` the first bad line fails the job (as the original job
    did) instead of being kept aside.

    The version and the session time come from one walk per line, made by a
    generator (see :func:`with_chosen_version`); what follows is cheap
    enough for the optimizer to copy where it filters early.
    """
    return _typed_lines(with_chosen_version(attach_versions(lines, versions, small)), mode)


def _typed_lines(chosen: DataFrame, mode: str) -> DataFrame:
    for step in _steps(mode):
        chosen = chosen.select(*step)
    return chosen


def parse_by_formats(lines: DataFrame, formats: DataFrame, mode: str = "quarantine") -> DataFrame:
    """As :func:`parse_lines`, from the catalog's rows: with more than ``MANY`` versions
    of any operator they are searched instead of walked. The result is the same."""
    most = formats.where(F.col("problem").isNull()).groupBy(*OP_KEY).count().agg(F.max("count")).first()[0] or 0
    if most > MANY:
        return _typed_lines(with_ranked_version(lines, formats), mode)
    return parse_lines(lines, versions_per_operator(formats), mode=mode)


@built_once
def _steps(mode: str) -> list[list[Column | str]]:
    """The projections of :func:`parse_lines` behind the version choice, in order."""
    reason = (F.when(F.col("datatype") == UNPLACED, F.lit("bad_path"))
              .when(F.col("op").isNull() | (F.col("op") == ""), F.lit("no_operator"))
              .when(F.col("versions").isNull(), F.lit("unknown_operator"))
              .when(F.col("_v").isNull(), F.lit("no_valid_format")))
    if mode == "failfast":
        reason = F.when(reason.isNotNull(), F.raise_error(F.concat(
            F.lit("bad CDR line ("), reason, F.lit(") in "), F.col("source_file")))).cast("string")
    elif mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    base = [*TAG_COLUMNS, "line", "_v", reason.alias("reason"),
            split_line(F.col("line"), F.col("_v.delim_rx")).alias("_parts"), "_v_time"]
    raw = [*TAG_COLUMNS, "line", "reason",
           F.col("_v.format_id").alias("format_id"), F.col("_v.format_name").alias("format_name"),
           F.col("_v_time").alias("session_time"),
           *[field_at(F.col("_parts"), F.col(f"_v.layout.{n}.pos")).alias(f"_raw_{n}")
             for n in LINE_FIELDS if n != EPOCH_TARGET],
           *[F.col(f"_v.layout.{n}.type").alias(f"_type_{n}") for n in LINE_FIELDS]]
    values = [F.col(n) if n == EPOCH_TARGET else
              _typed(n, F.col(f"_raw_{n}"), F.col(f"_type_{n}")).alias("urls" if n == URL_TARGET else n)
              for n in LINE_FIELDS]
    return [base, raw, [*TAG_COLUMNS, "line", *values, "format_id", "format_name", "reason",
                        to_timestamp(F.col("session_time")).alias("session_ts")]]


def good_rows(parsed: DataFrame, *more: str) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select(*STD_COLUMNS, *more)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)


def standardize(lines: DataFrame, versions: DataFrame,
                small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """(standard rows, quarantined lines) of one set of lines."""
    parsed = parse_lines(lines, versions, small)
    return good_rows(parsed), rejected_rows(parsed)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Quarantined lines per data centre, operator and reason."""
    return rejected.groupBy("dc", "datatype", "op", "reason").agg(F.count(F.lit(1)).alias("lines"))
