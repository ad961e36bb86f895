"""CDR text lines built from the driver tables ``events`` and ``pages``.

Each event becomes one delimited line in the layout of the format version
valid at its time, so the engine's parsing, format choice, dictionaries and
counts run on real text whose volume grows with the tables. The same
construction is written in SQL in :mod:`cdrflow.plans.oracle`.

Layouts (one descriptor per data centre, operator and version):

* v1 from 2024-01-02: 14 fields, ``;``, session time in epoch seconds;
* v2 from 2024-01-10: a ``cell_id`` field after ``imei`` (not a target
  column), session time as ``yyyy-MM-dd HH:mm:ss`` text, ``page_sent`` as text;
* v3 from 2024-01-20: as v1 but ``|``-delimited, time and duration typed LONG.

Events before 2024-01-02 have no valid format; operator ``zetanet`` has no
descriptor at all. U2 rows leave out the trailing ``extra`` field.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import extract_urls
from ..functions.time import epoch_from_ntz
from ..operators.asof import catalog_fits, versions_per_operator
from ..operators.joins import lookup_join, measure, within_bounds
from ..operators.partitioning import spread
from ..schema import LINE_FIELDS
from ..session import built_once, scratch_path
from ..sources.descriptors import parse_descriptors

DATATYPE = "webcdr"
DATA_CENTRES = ["dc0", "dc1"]
OPERATORS = ["alphanet", "betacell", "gammatel", "zetanet"]
DESCRIBED_OPERATORS = OPERATORS[:3]
VERSION_STARTS = {"v1": "2024-01-02 00:00:00", "v2": "2024-01-10 00:00:00",
                  "v3": "2024-01-20 00:00:00"}
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
REGISTERED_AT = 1_700_000_000_000

_TYPES = {"session_time": "int", "page_sent": "int", "duration": "int"}
_V1_FIELDS = [(name, _TYPES.get(name, "String"), "") for name in LINE_FIELDS]


def _layout(version: str) -> tuple[str, list[tuple[str, str, str]]]:
    fields = list(_V1_FIELDS)
    if version == "v2":
        fields.insert(3, ("cell_id", "String", ""))
        fields[fields.index(("session_time", "int", ""))] = ("session_time", "String", TIME_PATTERN)
        fields[fields.index(("page_sent", "int", ""))] = ("page_sent", "String", "")
        return ";", fields
    if version == "v3":
        fields[5] = ("session_time", "long", "")
        fields[fields.index(("duration", "int", ""))] = ("duration", "long", "")
        return "|", fields
    return ";", fields


def descriptor_text(version: str) -> str:
    """Properties text of one descriptor version."""
    delimiter, fields = _layout(version)
    body = {"fields": [{"name": n, "type": t, "format": f} for n, t, f in fields]}
    return "\n".join([
        f"format_start_date_time={VERSION_STARTS[version]}",
        "platform_name=webcdr",
        f"platform_format_version={version[1:]}",
        "operator=demo",
        f"delimiter={delimiter}",
        f"fields={json.dumps(body)}",
        "",
    ])


def descriptor_name(op: str, version: str) -> str:
    return f"data_format-{DATATYPE}-{op}-{version}.properties"


def descriptors(spark: SparkSession) -> DataFrame:
    """The feed's descriptor files as (dc, datatype, file_name, content, registered_at)."""
    rows = [(dc, DATATYPE, descriptor_name(op, v), descriptor_text(v), REGISTERED_AT)
            for dc in DATA_CENTRES for op in DESCRIBED_OPERATORS for v in VERSION_STARTS]
    return spark.createDataFrame(
        rows, "dc string, datatype string, file_name string, content string, registered_at bigint")


def formats(spark: SparkSession) -> DataFrame:
    return parse_descriptors(descriptors(spark))


_CATALOG_TABLES: dict[str, tuple[str, StructType, bool]] = {}


def catalog(spark: SparkSession) -> tuple[DataFrame, bool]:
    """The feed's grouped versions and whether their measured size allows a broadcast.

    As in the job, descriptors are registered once, into a table, which is
    measured when it is written; every query reads that table.
    """
    key = spark.sparkContext.applicationId
    if key not in _CATALOG_TABLES:
        v = versions_per_operator(formats(spark))
        path = scratch_path(spark, "feed-catalog")
        v.coalesce(1).write.parquet(path)
        _CATALOG_TABLES[key] = (path, v.schema, catalog_fits(spark.read.schema(v.schema).parquet(path)))
    path, schema, small = _CATALOG_TABLES[key]
    return spark.read.schema(schema).parquet(path), small


def versions(spark: SparkSession) -> DataFrame:
    return catalog(spark)[0]


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def identity(user_id: Column) -> dict[str, Column]:
    """Subscriber key columns of a numeric subscriber."""
    return {
        "dc": F.concat(F.lit("dc"), F.pmod(user_id, F.lit(2)).cast("string")),
        "op": F.element_at(F.array(*[F.lit(o) for o in OPERATORS]),
                           (F.pmod(user_id, F.lit(len(OPERATORS))) + 1).cast("int")),
        "msisdn": F.concat(F.lit("+33"), (user_id + 600000000).cast("string")),
        "imsi": F.when(F.pmod(user_id, F.lit(3)) == 0, F.lit(""))
                 .otherwise((user_id + 208010000000000).cast("string")),
        "imei": F.lit(""),
    }


def known_users(spark: SparkSession, sf_dir: str, segment: str | None = "BUILDING") -> DataFrame:
    """A subscriber dictionary already holding the customers of a segment (None: of all).

    Their ids are their customer keys (not dense), as a dictionary imported
    from an older system would be.
    """
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    if segment is not None:
        c = c.where(F.col("c_mktsegment") == segment)
    c = c.select("c_custkey")
    ident = identity(F.col("c_custkey"))
    return c.select(ident["dc"].alias("dc"), F.col("c_custkey").alias("user_id"),
                    *[ident[k].alias(k) for k in ("op", "msisdn", "imsi", "imei")],
                    F.lit(-1).cast("bigint").alias("batch_id"))


def known_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page dictionary already holding the https pages, in both data centres.

    Key is the page URL as found in a record (cut at '?'); id is page_id + 1.
    """
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").where(
        F.col("url").startswith("https:"))
    return p.select(F.explode(F.array(*[F.lit(d) for d in DATA_CENTRES])).alias("dc"),
                    (F.col("page_id") + 1).alias("page_id"),
                    F.get(extract_urls(F.col("url")), 0).alias("url"),
                    F.lit(-1).cast("bigint").alias("batch_id"))


_PAGE_SIZES: dict[tuple[str, str], tuple[int, int]] = {}


def _page_size(spark: SparkSession, sf_dir: str, pages: DataFrame) -> tuple[int, int]:
    """Rows and bytes of the pages' urls, measured once a session, as a table is when it is registered."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PAGE_SIZES:
        _PAGE_SIZES[key] = measure(pages)
    return _PAGE_SIZES[key]


def _events_with_urls(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    if events is None:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        rows = events.count()  # from the footers
        events = spread(events.select("event_id", "ts", "user_id", "event_type", "value"), rows=rows)
    events = events.select("event_id", "ts", "user_id", "event_type", "value")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    n_pages, page_bytes = _page_size(spark, sf_dir, pages)
    small = within_bounds(n_pages, page_bytes)
    if n_pages == 0:
        return events.withColumns({"url1": F.lit(None).cast("string"),
                                   "url2": F.lit(None).cast("string")})
    events = events.select("*", F.expr(f"pmod(event_id, {n_pages}) AS _p1"), F.expr(f"pmod(event_id * 7 + 3, {n_pages}) AS _p2"))
    first = pages.selectExpr("page_id AS _p1", "url AS url1")
    second = pages.selectExpr("page_id AS _p2", "url AS url2")
    joined = lookup_join(lookup_join(events, first, ["_p1"], "left", small=small),
                         second, ["_p2"], "left", small=small)
    return joined.drop("_p1", "_p2")


def cdr_feed(spark: SparkSession, sf_dir: str, batch_id: int = 0,
             events: DataFrame | None = None) -> DataFrame:
    """Tagged CDR lines (dc, datatype, batch_id, op, source_file, row_id, line, ts).

    ``events`` replaces the events table (e.g. one micro-batch of it).
    """
    version, columns = _feed_columns()
    batch = F.lit(batch_id).cast("bigint").alias("batch_id")
    return _events_with_urls(spark, sf_dir, events).select("*", version).select(*columns[:2], batch, *columns[2:])


@built_once
def _feed_columns() -> tuple[Column, list[Column]]:
    """The layout version of an event, and the feed's columns but the batch."""
    version = (F.when(F.col("ts") >= _ntz(VERSION_STARTS["v3"]), F.lit("v3"))
               .when(F.col("ts") >= _ntz(VERSION_STARTS["v2"]), F.lit("v2"))
               .otherwise(F.lit("v1")))
    sms = F.col("event_type") == "error"
    service = F.concat(F.lit("#"), (F.pmod(F.col("event_id"), F.lit(3)) + 700).cast("string"))
    n_urls = F.col("url1").isNotNull().cast("int") + F.col("url2").isNotNull().cast("int")
    urls_text = F.concat(service, F.lit("*#="), F.coalesce(F.col("url1"), F.lit("")),
                         F.lit(",1="), F.coalesce(F.col("url2"), F.lit("")))
    epoch_text = epoch_from_ntz(F.col("ts")).cast("string")
    ident = identity(F.col("user_id"))
    fields = {
        "msisdn": ident["msisdn"],
        "imsi": ident["imsi"],
        "imei": ident["imei"],
        "cell_id": F.pmod(F.col("user_id"), F.lit(97)).cast("string"),
        "subscription": F.lit(""),
        "language": F.when(F.pmod(F.col("event_id"), F.lit(4)) == 0, F.lit("")).otherwise(F.lit("en")),
        "session_time": F.when(F.col("_version") == "v2",
                               F.date_format(F.col("ts"), TIME_PATTERN)).otherwise(epoch_text),
        "service_code": service,
        "bearer": F.when(sms, F.lit("sms")).otherwise(F.lit("U2")),
        "page_sent": F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit("x"))
                      .when(sms, F.lit("0")).otherwise(n_urls.cast("string")),
        # under v3, typed LONG, some lie above the range of an int
        "duration": (F.floor(F.col("value")).cast("bigint") + F.when(
            (F.col("_version") == "v3") & (F.pmod(F.col("event_id"), F.lit(11)) == 0), F.lit(3_000_000_000))
            .otherwise(F.lit(0))).cast("string"),
        "vlr_number": F.lit("4917000"),
        "session_end": F.lit(""),
        "action_url": F.when(sms, F.lit("")).otherwise(urls_text),
        "extra": F.when(sms, F.concat(F.col("event_type"), F.lit("#digest"))),
    }
    v1 = [fields[n] for n, _, _ in _layout("v1")[1]]
    v2 = [fields[n] for n, _, _ in _layout("v2")[1]]
    line = (F.when(F.col("_version") == "v2", F.concat_ws(";", *v2))
            .when(F.col("_version") == "v3", F.concat_ws("|", *v1))
            .otherwise(F.concat_ws(";", *v1)))
    source_file = F.concat(
        F.lit("/landing/"), ident["dc"], F.lit(f"/{DATATYPE}/CDR_"), ident["op"], F.lit("_"),
        F.date_format(F.col("ts"), "yyyyMMdd_HH"), F.lit("0000_host"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("string"), F.lit("_0001"))
    return version.alias("_version"), [ident["dc"].alias("dc"), F.lit(DATATYPE).alias("datatype"), ident["op"].alias("op"),
                                       source_file.alias("source_file"), F.col("event_id").alias("row_id"), line.alias("line"), F.col("ts")]
