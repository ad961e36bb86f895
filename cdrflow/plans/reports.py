"""Queries over the driver tables, one per inventory item.

Every query starts from :func:`cdrflow.plans.feed.cdr_feed`, i.e. from CDR
text lines Spark builds out of ``events`` and ``pages``, and runs the
engine's own operators on them. Each has a DuckDB twin in
:mod:`cdrflow.plans.oracle` that derives the expected answer from the
source columns directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extract_urls, field_at, operator_from_name, split_line
from ..functions.time import epoch_from_text, utc_wall_time
from ..operators import dims, enrich, ids, metrics, migrate, standardize
from ..operators.partitioning import spread
from ..operators.staging import staged
from ..session import scratch_path
from ..sources import landing, tables
from ..streaming import arrival
from ..schema import DATA_FILE_PATTERN, DIM_USER_SCHEMA, ENRICHED_FIELDS
from ..sources.landing import file_name_of
from . import feed

BATCH = 1
# Second-batch boundary of ``dim_two_batches`` (epoch seconds of 2024-01-15 UTC).
SECOND_BATCH_FROM = 1705276800


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed feed lines."""
    versions, small = feed.catalog(spark)
    return standardize.parse_lines(feed.cdr_feed(spark, sf_dir, BATCH), versions, small)


def _std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize.good_rows(_parsed(spark, sf_dir))


def _stored_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(_std(spark, sf_dir), "standard-rows")


def file_operator(spark, sf_dir):
    """Operator from the data file name."""
    lines = feed.cdr_feed(spark, sf_dir, BATCH)
    return lines.select("row_id", "source_file", operator_from_name(
        file_name_of(F.col("source_file")), DATA_FILE_PATTERN).alias("op"))


def field_by_position(spark, sf_dir):
    """Fields by position after a ';' split (trailing empties kept)."""
    lines = feed.cdr_feed(spark, sf_dir, BATCH)
    parts = split_line(F.col("line"), ";")
    return lines.select("row_id", F.size(parts).alias("n_fields"),
                        field_at(parts, 0).alias("f0"), field_at(parts, 7).alias("f7"),
                        field_at(parts, 12).alias("f12"), field_at(parts, 14).alias("f14"))


def typed_or_empty(spark, sf_dir):
    """Typed fields; a failed conversion is empty in the text form."""
    std = _std(spark, sf_dir)
    return std.select("row_id",
                      F.coalesce(F.col("page_sent").cast("string"), F.lit("")).alias("page_sent"),
                      F.coalesce(F.col("duration").cast("string"), F.lit("")).alias("duration"),
                      F.coalesce(F.col("extra"), F.lit("")).alias("extra"))


def standard_rows(spark, sf_dir):
    """The 16 standard columns, URLs joined by ','."""
    std = _std(spark, sf_dir)
    return std.select("row_id", "dc", "op", "msisdn", "imsi", "imei", "subscription", "language",
                      "session_time", "service_code", "bearer", "page_sent", "duration",
                      "vlr_number", "session_end",
                      F.array_join("urls", ",").alias("action_url"), "extra", "format_name")


def format_asof(spark, sf_dir):
    """The format version chosen for every line."""
    parsed = _parsed(spark, sf_dir)
    return parsed.select("row_id", "dc", "op", "session_time", "format_name")


#: Versions per operator of ``format_asof_many``, and seconds between their starts.
MANY_VERSIONS, MANY_SECONDS = 1000, 2700


def format_asof_many(spark, sf_dir):
    """The version of every line where each operator has a thousand, a new one
    every 45 minutes, in the three layouts of the feed."""
    first = f"unix_seconds(TIMESTAMP'{feed.VERSION_STARTS['v1']} UTC')"
    start = f"{first} + id * {MANY_SECONDS}"
    era = " ".join(f"WHEN {start} >= unix_seconds(TIMESTAMP'{s} UTC') THEN '{v}'" for v, s in reversed(feed.VERSION_STARTS.items()))
    many = spark.range(MANY_VERSIONS).selectExpr("id AS n", f"{start} AS many_start", f"CASE {era} END AS layout_version")
    name = F.concat(F.lit(f"data_format-{feed.DATATYPE}-"), "op", F.lit("-"), F.col("n").cast("string"), F.lit(".properties"))
    formats = (feed.formats(spark).withColumn("layout_version", F.regexp_extract("format_name", r"-(v\d)\.", 1))
               .join(F.broadcast(many), "layout_version")
               .withColumns({"start_time": F.col("many_start"), "format_name": name, "format_id": F.concat_ws("/", "dc", name)}))
    parsed = standardize.parse_by_formats(feed.cdr_feed(spark, sf_dir, BATCH), staged(formats, "many-formats"))
    return parsed.select("row_id", "dc", "op", "session_time", "format_name", "reason")


def format_rejects(spark, sf_dir):
    """Quarantined lines and why."""
    rejected = standardize.rejected_rows(_parsed(spark, sf_dir))
    return rejected.select("row_id", "dc", "op", "reason")


def reject_counts(spark, sf_dir):
    """Quarantined lines per data centre, operator and reason."""
    rejected = standardize.rejected_rows(_parsed(spark, sf_dir))
    return standardize.reject_counts(rejected).drop("datatype")


def formats_per_operator(spark, sf_dir):
    """Format versions in use per operator, oldest first, with their rows."""
    std = _std(spark, sf_dir)
    return (std.groupBy("dc", "op")
            .agg(F.array_join(F.array_sort(F.collect_set("format_name")), ",").alias("formats"),
                 F.count(F.lit(1)).alias("rows")))


def rows_per_format(spark, sf_dir):
    """Rows read through each format version."""
    std = _std(spark, sf_dir)
    return std.groupBy("dc", "op", "format_name").agg(F.count(F.lit(1)).alias("rows"))


def page_list(spark, sf_dir):
    """Each row's page URLs with their 0-based place, repeats kept."""
    std = _std(spark, sf_dir)
    return (std.select("row_id", "dc", F.posexplode("urls").alias("pos", "url"))
            .where(F.length("url") > 0)
            .withColumn("pos", F.col("pos").cast("int")))


def page_hits(spark, sf_dir):
    """Hits per page URL."""
    return metrics.page_hits(_std(spark, sf_dir), by="url")


def user_keys(spark, sf_dir):
    """Distinct subscriber keys."""
    return dims.user_keys(_std(spark, sf_dir))


def max_user_id(spark, sf_dir):
    """Highest id per data centre of a dictionary of all customers."""
    known = feed.known_users(spark, sf_dir, segment=None)
    return ids.highest_ids(known, "user_id").withColumnRenamed("_start", "max_user_id")


def new_user_ids(spark, sf_dir):
    """Ids for subscribers not yet in the dictionary."""
    rows = dims.new_users(_std(spark, sf_dir), feed.known_users(spark, sf_dir), BATCH)
    return rows.drop("batch_id")


def new_page_ids(spark, sf_dir):
    """Ids for pages not yet in the dictionary."""
    rows = dims.new_pages(_std(spark, sf_dir), feed.known_pages(spark, sf_dir), BATCH)
    return rows.drop("batch_id")


def _dims(spark, sf_dir, std):
    """Dictionaries after this batch, stored like the batch job's appended tables."""
    known_u = feed.known_users(spark, sf_dir)
    known_p = feed.known_pages(spark, sf_dir)
    dim_user = dims.extend(known_u, dims.new_users(std, known_u, BATCH))
    dim_page = dims.extend(known_p, dims.new_pages(std, known_p, BATCH))
    return staged(dim_user, "dim-user"), staged(dim_page, "dim-page")


def dim_after_append(spark, sf_dir):
    """The subscriber dictionary after this batch is appended."""
    std = _stored_std(spark, sf_dir)
    dim_user, _ = _dims(spark, sf_dir, std)
    return dim_user.drop("batch_id")


def user_substitution(spark, sf_dir):
    """Every row's subscriber id, known or new."""
    std = _stored_std(spark, sf_dir)
    dim_user, _ = _dims(spark, sf_dir, std)
    return enrich.with_user_ids(std, dim_user).select("row_id", "user_id")


def page_substitution(spark, sf_dir):
    """Every row's page ids in URL order, repeats kept."""
    std = _stored_std(spark, sf_dir)
    _, dim_page = _dims(spark, sf_dir, std)
    rows = enrich.with_page_ids(std, dim_page)
    return rows.select("row_id", enrich.page_ids_text(F.col("page_ids")).alias("page_ids"))


def enriched_rows(spark, sf_dir):
    """The 12 output columns and their text line."""
    std = _stored_std(spark, sf_dir)
    dim_user, dim_page = _dims(spark, sf_dir, std)
    rows = enrich.enrich(std, dim_user, dim_page)
    return rows.select("row_id", *[c for c in ENRICHED_FIELDS if c != "page_ids"],
                       enrich.page_ids_text(F.col("page_ids")).alias("page_ids"),
                       enrich.text_line().alias("text"))


def hits_per_page_id(spark, sf_dir):
    """Hits per page id after substitution."""
    std = _stored_std(spark, sf_dir)
    _, dim_page = _dims(spark, sf_dir, std)
    return metrics.page_hits(enrich.with_page_ids(std, dim_page), by="page_id")


def bucket_counts(spark, sf_dir):
    """Sessions, seconds and pages per key and hour."""
    return metrics.bucket_counts(_std(spark, sf_dir))


def window_counts(spark, sf_dir):
    """Sessions per operator and 15-minute window."""
    return metrics.window_counts(_std(spark, sf_dir), seconds=900)


def epoch_time(spark, sf_dir):
    """session time as epoch seconds, milliseconds and UTC text."""
    std = _std(spark, sf_dir)
    return std.select("row_id", "session_time",
                      F.unix_millis("session_ts").alias("session_ms"),
                      F.date_format(utc_wall_time(F.col("session_time")),
                                    "yyyy-MM-dd HH:mm:ss").alias("session_utc"))


def date_parse(spark, sf_dir):
    """the v2 time field of every line read with its pattern; NULL when not a date."""
    lines = feed.cdr_feed(spark, sf_dir, BATCH)
    raw = field_at(split_line(F.col("line"), ";"), 6)
    return lines.select("row_id", epoch_from_text(raw, feed.TIME_PATTERN, "UTC").alias("parsed"))


def json_fields(spark, sf_dir):
    """a JSON field read with an explicit schema."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "props")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def dim_two_batches(spark, sf_dir):
    """The subscriber dictionary kept over two batches, starting empty."""
    std = _stored_std(spark, sf_dir)
    first = std.where(F.col("session_time") < SECOND_BATCH_FROM)
    second = std.where(F.col("session_time") >= SECOND_BATCH_FROM)
    dim0 = spark.createDataFrame([], DIM_USER_SCHEMA)
    dim1 = dims.extend(dim0, dims.new_users(first, dim0, 1))
    dim2 = dims.extend(dim1, dims.new_users(second, dim1, 2))
    return dim2


def legacy_page_ids(spark, sf_dir):
    """An old page dictionary whose ids were reused (two pages per id)
    brought into the id rules: lowest id per URL, fresh ids for later holders."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    legacy = pages.select(F.lit("dc0").alias("dc"),
                          (F.floor(F.col("page_id") / 2) + 1).cast("bigint").alias("page_id"),
                          F.get(extract_urls(F.col("url")), 0).alias("url"),
                          F.lit(-1).cast("bigint").alias("batch_id"))
    return migrate.settle_ids(legacy, dims.PAGE_KEY, "page_id").drop("batch_id")


def landing_files(spark, sf_dir):
    """The feed written as text files in a ``dc=/datatype=/op=``
    landing under the shared folder, read back by the landing reader, parsed
    and counted per page."""
    root = scratch_path(spark, "landing")
    (feed.cdr_feed(spark, sf_dir, BATCH).select("dc", "datatype", "op", "line")
     .write.partitionBy("dc", "datatype", "op").text(root))
    versions, small = feed.catalog(spark)
    lines = landing.read_landing(spark, root, BATCH, partitioned=True)
    std = standardize.good_rows(standardize.parse_lines(lines, versions, small))
    return metrics.page_hits(std, by="url")


BUCKET_KEYS = ["dc", "op", "service_code", "bearer", "bucket"]


def arrival_counts(spark, sf_dir):
    """Events arrive as files; each micro-batch becomes CDR lines,
    is parsed and counted per hour, and the per-batch counts are summed.

    Each micro-batch writes its own ``epoch=`` folder with overwrite, so a
    replayed batch replaces rather than adds.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", arrival.MAX_FILES_PER_BATCH)
              .parquet(sf_dir))
    sink = scratch_path(spark, "arrival-counts")
    versions, small = feed.catalog(spark)

    def each(batch: DataFrame, epoch_id: int) -> None:
        lines = feed.cdr_feed(spark, sf_dir, BATCH, events=spread(batch))
        std = standardize.good_rows(standardize.parse_lines(lines, versions, small))
        (metrics.bucket_counts(std).write.mode("overwrite")
         .parquet(f"{sink}/epoch={epoch_id}"))

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", scratch_path(spark, "arrival-counts-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    per_batch = tables.read_table(spark, sink)
    if per_batch is None:
        per_batch = spark.createDataFrame([], "dc string, op string, service_code string, bearer string, "
                                              "bucket string, sessions bigint, duration bigint, pages bigint")
    return per_batch.groupBy(*BUCKET_KEYS).agg(
        F.sum("sessions").alias("sessions"), F.sum("duration").alias("duration"),
        F.sum("pages").alias("pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "file_operator": file_operator,
    "field_by_position": field_by_position,
    "typed_or_empty": typed_or_empty,
    "standard_rows": standard_rows,
    "format_asof": format_asof,
    "format_asof_many": format_asof_many,
    "format_rejects": format_rejects,
    "reject_counts": reject_counts,
    "formats_per_operator": formats_per_operator,
    "rows_per_format": rows_per_format,
    "page_list": page_list,
    "page_hits": page_hits,
    "user_keys": user_keys,
    "max_user_id": max_user_id,
    "new_user_ids": new_user_ids,
    "new_page_ids": new_page_ids,
    "dim_after_append": dim_after_append,
    "user_substitution": user_substitution,
    "page_substitution": page_substitution,
    "enriched_rows": enriched_rows,
    "hits_per_page_id": hits_per_page_id,
    "bucket_counts": bucket_counts,
    "window_counts": window_counts,
    "epoch_time": epoch_time,
    "date_parse": date_parse,
    "json_fields": json_fields,
    "dim_two_batches": dim_two_batches,
    "arrival_counts": arrival_counts,
    "legacy_page_ids": legacy_page_ids,
    "landing_files": landing_files,
}
