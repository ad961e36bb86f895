"""Queries that run the job itself: landings, batches, streams, the catalog and
imported dictionaries, on files that Spark writes from the driver tables.

Files go to the shared scratch folder. The SQL twins are in
:mod:`cdrflow.plans.jobs_oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extract_urls
from ..functions.time import utc_wall_time
from ..schema import LINE_FIELDS
from ..session import scratch_path
from ..sources import dictionary, tables
from ..sources.descriptors import format_fields, parse_descriptors
from ..sources.landing import read_landing
from ..sources.tables import Warehouse
from ..streaming import arrival, usage
from ..operators import enrich
from ..operators.dims import user_keys
from ..operators.partitioning import spread
from ..operators.staging import staged
from ..sources.batches import Batches
from . import batch, feed, reports


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_descriptors(spark: SparkSession, root: str, dcs=feed.DATA_CENTRES, versions=feed.VERSION_STARTS) -> None:
    for dc in dcs:
        for op in feed.DESCRIBED_OPERATORS:
            for v in versions:
                _put(spark, f"{root}/{dc}/{feed.DATATYPE}/{feed.descriptor_name(op, v)}", feed.descriptor_text(v))


def write_landing(spark: SparkSession, lines: DataFrame, root: str, prefix: str = "CDR_", below: str = "") -> None:
    """``lines`` (dc, op, line) as ``<root>/<dc>/<datatype>/<below><prefix><op>_<date>_<time>_<n>``:
    written by Spark, as many files per operator as an eighth of the cores and one,
    then given their names (one rename per file)."""
    path = scratch_path(spark, "staged-landing")
    files = spark.sparkContext.defaultParallelism // 8 + 1
    (lines.select("dc", "op", "line").repartition("dc", "op", F.pmod(F.xxhash64("line"), F.lit(files)))
     .write.partitionBy("dc", "op").text(path))
    pattern, fs = _file_system(spark, f"{path}/dc=*/op=*/part-*")
    for i, found in enumerate(sorted(str(f.getPath().toString()) for f in fs.globStatus(pattern) or [])):
        dc, op = (found.rsplit("/", 3)[j].split("=", 1)[1] for j in (1, 2))
        source, _ = _file_system(spark, found)
        target, _ = _file_system(spark, f"{root}/{dc}/{feed.DATATYPE}/{below}{prefix}{op}_20240101_000000_h{i}")
        fs.mkdirs(target.getParent())
        fs.rename(source, target)


def _landing(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "job-landing")
    write_landing(spark, feed.cdr_feed(spark, sf_dir), root)
    return root


def _per_batch(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Stored lines per batch, data centre, operator and reason ('' when good)."""
    return (tables.read_table(spark, wh.records).groupBy("batch_id", "dc", F.coalesce("op", F.lit("")).alias("op"),
                                                         F.coalesce("reason", F.lit("")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("lines")))


def second_run_reads_nothing(spark, sf_dir):
    """A second batch over the same landing takes no file."""
    root, wh = _landing(spark, sf_dir), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root)
    for n in (1, 2):
        batch.run_batch(spark, root, wh.root, n)
    return _per_batch(spark, wh)


def rerun_totals(spark, sf_dir):
    """A batch run again, with a descriptor that was missing, is replaced as a whole."""
    root, wh = _landing(spark, sf_dir), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root, versions=["v2"])
    batch.run_batch(spark, root, wh.root, 7)
    write_descriptors(spark, root)
    batch.run_batch(spark, root, wh.root, 7)
    text = spark.read.text(wh.text)
    found = tables.read_table(spark, wh.records).groupBy(F.coalesce("reason", F.lit("")).alias("part")).agg(F.count(F.lit(1)).alias("lines"))
    return found.unionAll(text.agg(F.lit("text").alias("part"), F.count(F.lit(1)).alias("lines")))


def landing_paths(spark, sf_dir):
    """Numeric data centres, a file name with a further prefix, a
    file without an operator and one too deep, from the path layout."""
    root = scratch_path(spark, "job-landing")
    lines = feed.cdr_feed(spark, sf_dir)
    numeric = lines.withColumn("dc", F.when(F.col("dc") == "dc0", "001").otherwise("1"))
    write_landing(spark, numeric.where("row_id % 4 < 2"), root)
    write_landing(spark, numeric.where("row_id % 4 = 2"), root, prefix="XCDR_")
    write_landing(spark, numeric.where("row_id % 4 = 3 and row_id % 8 = 3"), root, prefix="dump-")
    write_landing(spark, numeric.where("row_id % 4 = 3 and row_id % 8 = 7"), root, below="older/")
    got = read_landing(spark, root, 1)
    return got.groupBy("dc", "datatype", F.coalesce("op", F.lit("")).alias("op")).agg(F.count(F.lit(1)).alias("lines"))


def landing_rejects(spark, sf_dir):
    """Every line of every file is stored, with its reason when it isn't good."""
    root, wh = scratch_path(spark, "job-landing"), Warehouse(scratch_path(spark, "job-warehouse"))
    lines = feed.cdr_feed(spark, sf_dir)
    write_landing(spark, lines.where("row_id % 3 = 0"), root)
    write_landing(spark, lines.where("row_id % 3 = 1"), root, prefix="dump-")
    write_landing(spark, lines.where("row_id % 3 = 2"), root, below="older/")
    write_descriptors(spark, root)
    batch.run_batch(spark, root, wh.root, 3)
    return _per_batch(spark, wh).drop("batch_id", "op").groupBy("dc", "reason").agg(F.sum("lines").alias("lines"))


def two_checkpoints(spark, sf_dir):
    """Two streams, each with a second run, into one warehouse."""
    wh = Warehouse(scratch_path(spark, "job-warehouse"))
    lines = feed.cdr_feed(spark, sf_dir)
    for dc in feed.DATA_CENTRES:
        root, checkpoint = scratch_path(spark, "job-landing"), scratch_path(spark, "job-checkpoint")
        write_descriptors(spark, root, dcs=[dc])
        own = lines.where(F.col("dc") == dc)
        write_landing(spark, own.where("row_id % 2 = 0"), root)
        arrival.run_available(spark, root, wh.root, checkpoint)
        write_landing(spark, own.where("row_id % 2 = 1"), root, prefix="late-CDR_")
        arrival.run_available(spark, root, wh.root, checkpoint)
        arrival.run_available(spark, root, wh.root, checkpoint)
    enriched = tables.read_table(spark, wh.enriched)
    return enriched.groupBy("dc").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"),
                                      F.sum(F.size("page_ids")).alias("hits"))


# Files that are touched, sent again, oddly named or hold odd lines -----------

def _counts(spark: SparkSession, wh: Warehouse, *keys: str) -> DataFrame:
    """Stored lines of whole batches per key, '' for null."""
    found = batch.output(spark, wh, "records")
    return found.groupBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("lines"))


def _files(spark: SparkSession, root: str) -> list[str]:
    pattern, fs = _file_system(spark, f"{root}/*/{feed.DATATYPE}/*CDR_*")
    return sorted(str(f.getPath().toString()) for f in fs.globStatus(pattern) or [])


def touched_file(spark, sf_dir):
    """Every file gets a new time, and half of them are written again with
    their lines in another order, between two batches; each line is stored once."""
    root, wh = _landing(spark, sf_dir), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root)
    batch.run_batch(spark, root, wh.root, 1)
    for i, path in enumerate(_files(spark, root)):
        p, fs = _file_system(spark, path)
        if i % 2:
            again = scratch_path(spark, "sent-again")
            (spark.read.text(path).coalesce(1).sortWithinPartitions(F.xxhash64("value")).write.text(again))
            parts, _ = _file_system(spark, f"{again}/part-*")
            fs.delete(p, False)
            fs.rename(fs.globStatus(parts)[0].getPath(), p)
        fs.setTimes(p, 1_900_000_000_000 + i, -1)
    batch.run_batch(spark, root, wh.root, 2)
    return _counts(spark, wh, "dc", "op", "reason")


def batch_and_stream_one_landing(spark, sf_dir):
    """A batch, a stream and a further batch read one landing that
    grows in between; each file is taken by the first that sees it."""
    root, wh = scratch_path(spark, "job-landing"), Warehouse(scratch_path(spark, "job-warehouse"))
    lines, checkpoint = feed.cdr_feed(spark, sf_dir), scratch_path(spark, "job-checkpoint")
    write_descriptors(spark, root)
    write_landing(spark, lines.where("row_id % 3 = 0"), root)
    batch.run_batch(spark, root, wh.root, 1)
    write_landing(spark, lines.where("row_id % 3 = 1"), root, prefix="b-CDR_")
    arrival.run_available(spark, root, wh.root, checkpoint)
    write_landing(spark, lines.where("row_id % 3 = 2"), root, prefix="c-CDR_")
    batch.run_batch(spark, root, wh.root, 2)
    arrival.run_available(spark, root, wh.root, checkpoint)
    kind = F.when(F.col("batch_id") <= 2, F.concat(F.lit("batch "), F.col("batch_id").cast("string"))).otherwise("stream")
    return (batch.output(spark, wh, "records").groupBy(kind.alias("taken_by"), F.coalesce("reason", F.lit("")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("lines")))


#: What a file may be called, between its operator's name and its end.
ODD_NAMES = ("h[2]_2", "a{b,c}", "what?", "star*", "two words", "per%20cent", "plus+sign", "ümlaut")


def odd_file_names(spark, sf_dir):
    """Files whose names hold the letters of patterns, blanks and others."""
    root, wh = scratch_path(spark, "job-landing"), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root)
    lines = feed.cdr_feed(spark, sf_dir)
    for i in range(2):
        write_landing(spark, lines.where(F.pmod("row_id", F.lit(2)) == i), root, prefix=f"{i}-CDR_")
        for n, path in enumerate(_files(spark, root)):
            p, fs = _file_system(spark, path)
            name = str(p.getName())
            if not any(name.endswith(odd) for odd in ODD_NAMES):
                target, _ = _file_system(spark, f"{path.rsplit('/', 1)[0]}/{name}_{ODD_NAMES[n % len(ODD_NAMES)]}")
                fs.rename(p, target)
        batch.run_batch(spark, root, wh.root, i + 1)
    return _counts(spark, wh, "batch_id", "dc", "op", "reason")


def odd_times(spark, sf_dir):
    """Session times in milliseconds, microseconds, beyond a long, negative
    or no number at all; each line is stored, those without a time as rejected."""
    root, wh = scratch_path(spark, "job-landing"), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    ident, kind, t = feed.identity(F.col("user_id")), F.pmod("event_id", F.lit(9)), F.col("t").cast("string")
    time = (F.when(kind == 0, t).when(kind == 1, F.concat(t, F.lit("000"))).when(kind == 2, F.concat(t, F.lit("000000")))
            .when(kind == 3, F.concat(t, F.lit("00000000000000"))).when(kind == 4, F.concat(F.lit("-"), t))
            .when(kind == 5, "soon").when(kind == 6, "").when(kind == 7, "9223372036854775807").otherwise(F.lit("253402300799")))
    fields = {"msisdn": ident["msisdn"], "session_time": time, "page_sent": F.lit("0"), "duration": F.lit("1")}
    line = F.concat_ws(";", *[fields.get(n, F.lit("")) for n in LINE_FIELDS[:-1]])
    write_landing(spark, ev.select(ident["dc"].alias("dc"), ident["op"].alias("op"), line.alias("line")), root)
    batch.run_batch(spark, root, wh.root, 1)
    stored = batch.output(spark, wh, "records")
    return stored.groupBy(F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce(F.year(utc_wall_time(F.col("session_time"))), F.lit(0)).alias("year")).agg(
        F.count(F.lit(1)).alias("lines"))


# Batches that are broken off, late descriptors, several writers ----------------

def half_written_batch(spark, sf_dir):
    """Of a batch that stopped behind its records nothing shows in any output."""
    root, wh = scratch_path(spark, "job-landing"), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root)
    lines = feed.cdr_feed(spark, sf_dir)
    write_landing(spark, lines.where("row_id % 2 = 0"), root)
    batch.run_batch(spark, root, wh.root, 1)
    Batches(spark, wh).open(2)
    batch.parse_and_store(spark, lines.where("row_id % 2 = 1").drop("ts").withColumn("batch_id", F.lit(2).cast("bigint")), wh, 2)
    parts = [batch.output(spark, wh, name).agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows"))
             for name in ("records", "enriched", "text")]
    usage = batch.output(spark, wh, "usage").agg(F.lit("usage").alias("output"), F.sum("sessions").alias("rows"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(usage)


def late_descriptor(spark, sf_dir):
    """Two batches without one version's descriptors, which then arrive;
    the result is that of a run that had them all along."""
    root, late, wh = _landing(spark, sf_dir), scratch_path(spark, "job-late"), Warehouse(scratch_path(spark, "job-warehouse"))
    write_descriptors(spark, root, versions=["v1", "v3"])
    batch.run_batch(spark, root, wh.root, 1)
    write_landing(spark, feed.cdr_feed(spark, sf_dir).where("row_id % 5 = 0"), root, prefix="more-CDR_")
    batch.run_batch(spark, root, wh.root, 2)
    write_descriptors(spark, late, versions=["v2"])
    batch.apply_late_descriptors(spark, late, wh.root)
    rows = batch.output(spark, wh, "records")
    text = batch.output(spark, wh, "text").groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.count(F.lit(1)).alias("lines"))
    return (rows.groupBy("batch_id", F.coalesce("reason", F.regexp_extract("format_name", r"-(v\d)\.", 1)).alias("read_as"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("session_time").alias("times"))
            .unionAll(text.select("batch_id", F.lit("text").alias("read_as"), "lines", F.lit(None).cast("bigint").alias("times"))))


def ids_two_writers(spark, sf_dir):
    """Two batches read the dictionary before either appends to it; ids
    are dense per data centre and no key has two. The first takes the even
    events, the second the odd ones; which ids a key gets is the race's."""
    wh = Warehouse(scratch_path(spark, "job-warehouse"))
    held = dictionary.users(spark, wh)
    known = feed.known_users(spark, sf_dir)
    held.commit(known, held.snapshot())
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ident = feed.identity(F.col("user_id"))
    keys = events.select("event_id", *[ident[k].alias(k) for k in ident])
    seen = held.snapshot()
    for n in (0, 1):  # both work from the same state
        held.extend(keys.where(F.pmod("event_id", F.lit(2)) == n).select(*held.key).distinct(), n + 1, at=seen)
    return held.rows().groupBy("dc").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("ids"),
                                         F.count_distinct("op", "msisdn", "imsi", "imei").alias("keys"), F.max("user_id").alias("highest"))


def usage_stream(spark, sf_dir):
    """Usage per 15 minutes kept by a stream over three runs from one
    checkpoint; the second brings earlier times than the first, the third lines again."""
    root, out, checkpoint = (scratch_path(spark, f"usage-{n}") for n in ("landing", "counts", "checkpoint"))
    lines, formats = feed.cdr_feed(spark, sf_dir), staged(feed.formats(spark), "usage-formats")
    for n, (part, prefix) in enumerate((("row_id % 3 > 0", ""), ("row_id % 3 = 0", "late-"), ("row_id % 5 = 0", "again-"))):
        write_landing(spark, lines.where(part), root, prefix=f"{prefix}CDR_")
        usage.run_available(spark, root, formats, out, checkpoint, delay="60 days")
    return usage.usage_now(spark, out)


def archived_landing(spark, sf_dir):
    """A stream that moves finished files away; after its second run none of
    the first run's files is left to be listed."""
    root, formats, archive, checkpoint = (scratch_path(spark, f"archived-{n}") for n in ("landing", "formats", "archive", "checkpoint"))
    wh, lines = Warehouse(scratch_path(spark, "job-warehouse")), feed.cdr_feed(spark, sf_dir)
    write_descriptors(spark, formats)
    for n in range(2):
        write_landing(spark, lines.where(F.pmod("row_id", F.lit(2)) == n), root, prefix=f"run{n}-CDR_")
        arrival.run_available(spark, root, wh.root, checkpoint, descriptor_root=formats, archive=archive)
    names = [path.rsplit("/", 1)[1] for path in _files(spark, root)]
    left = spark.createDataFrame([("left of the first run", sum(x.startswith("run0-") for x in names))], "reason string, lines bigint")
    return _counts(spark, wh, "reason").unionAll(left)


def dim_compacted(spark, sf_dir):
    """Rows are looked up in a dictionary of a compact form and later commits."""
    wh = Warehouse(scratch_path(spark, "job-warehouse"))
    held = dictionary.users(spark, wh)
    held.commit(feed.known_users(spark, sf_dir), held.snapshot())
    held.compact()
    std = staged(reports._std(spark, sf_dir), "standard-rows")
    held.extend(user_keys(std), 1)
    return enrich.with_user_ids(std, held.layers()).select("row_id", "user_id")


# Descriptors made from the customers: one file each ------------------------

def _descriptor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A descriptor per customer: fields by balance, faults by key."""
    c = spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment"))
    key = F.col("c_custkey")
    fault = F.pmod(key, F.lit(7))

    def field(name: str, kind, form="") -> Column:
        return F.concat(F.lit(f'{{"name":"{name}","type":"'), F.lit(kind) if isinstance(kind, str) else kind,
                        F.lit('","format":"'), F.lit(form) if isinstance(form, str) else form, F.lit('"}'))
    timed = F.pmod(key, F.lit(2)) == 0
    names = [n for n in LINE_FIELDS if n not in ("session_time", "imei")]
    fields = F.concat_ws(",", field("cell", "String"), *(field(n, "String", "not a date: nnn") for n in names[:4]),
                         F.when(fault != 3, field("session_time", F.when(timed, "String").otherwise("long"),
                                                  F.when(fault == 4, "EEE yyyy").when(timed, "yyyy-MM-dd\\ HH\\:mm:ss").otherwise(""))),
                         *(field(n, "int") for n in names[4:]))
    start = F.date_format(utc_wall_time(F.lit(1_600_000_000) + F.pmod(key, F.lit(50)) * 86_400), "yyyy-MM-dd HH:mm:ss")
    content = F.concat(
        F.lit("# \\u0041 descriptor \\\n!delimiter=x\r\n \t\r"), F.when(fault != 1, F.concat(F.lit("format_start_date_time="), F.when(fault == 2, "soon").otherwise(start), F.lit("\n"))).otherwise(""),
        F.lit("delimiter="), F.when(F.pmod(key, F.lit(6)) == 0, "").when(F.pmod(key, F.lit(6)) == 3, "\\\\\\u0074\\t\\\n  |")
        .when(F.pmod(key, F.lit(3)) == 1, "|").otherwise("\\u003B"), F.lit("\r\n"),
        F.lit('  fi\\u0065lds : {"fields":[\\\n\t  '), F.when(fault != 5, fields).otherwise(""), F.lit("]}\n"))
    name = F.when(fault == 6, F.concat(F.lit("format-"), key.cast("string"), F.lit(".properties"))).otherwise(
        F.concat(F.lit("data_format-x-op"), F.col("c_nationkey").cast("string"), F.lit("-"), key.cast("string"), F.lit(".properties")))
    return c.select(F.concat(F.lit("dc"), F.pmod(key, F.lit(2)).cast("string")).alias("dc"), F.lit("webcdr").alias("datatype"),
                    name.alias("file_name"), content.alias("content"), (key * 10).cast("bigint").alias("registered_at"))


def descriptor_fields(spark, sf_dir):
    """Each accepted descriptor's operator, delimiter and fields."""
    good = parse_descriptors(_descriptor_files(spark, sf_dir)).where(F.col("problem").isNull()).drop("layout", "field_names")
    good = staged(good, "descriptors")  # read twice below, parsed once
    place = format_fields(good).select("format_id", "field", "pos", "type")
    return good.select("format_id", "format_name", "delimiter", "start_time").join(place, "format_id").drop("format_id")


def descriptor_problems(spark, sf_dir):
    """What is wrong with each descriptor, '' when nothing is."""
    return parse_descriptors(_descriptor_files(spark, sf_dir)).select("file_name", F.coalesce("problem", F.lit("")).alias("problem"))


def catalog_versions(spark, sf_dir):
    """Registered versions per operator, oldest first, a tie to the newest registration."""
    from ..operators.asof import versions_per_operator
    found = versions_per_operator(parse_descriptors(_descriptor_files(spark, sf_dir)))
    last = F.element_at("versions", -1)
    return found.select("dc", "op", F.size("versions").cast("bigint").alias("versions"),
                        last["format_name"].alias("newest"), F.get("versions", 0)["start_time"].alias("first_start"))


# Imported dictionaries -----------------------------------------------------

def _import(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A dictionary of half the customers and pages; text dictionaries, with ids
    that are in use, of all of them, imported on top."""
    wh, legacy = Warehouse(scratch_path(spark, "job-warehouse")), scratch_path(spark, "job-legacy")
    users = feed.known_users(spark, sf_dir)
    pages = feed.known_pages(spark, sf_dir)
    for held, rows in ((dictionary.users(spark, wh), users), (dictionary.pages(spark, wh), pages)):
        held.commit(rows, held.snapshot())
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    ident = feed.identity(F.col("c_custkey"))
    old = c.select(ident["dc"].alias("dc"), F.concat_ws(";", F.when(F.pmod("c_custkey", F.lit(13)) == 0, "none").otherwise((F.col("c_custkey") + 3).cast("string")),
                                                        ident["dc"], ident["op"], ident["msisdn"], ident["imsi"], ident["imei"]).alias("value"))
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.get(extract_urls(F.col("url")), 0).alias("url"))
    for dc in feed.DATA_CENTRES:
        old.where(F.col("dc") == dc).select("value").write.text(f"{legacy}/{dc}/user")
        p.select(F.concat_ws(";", F.floor(F.col("page_id") / 2).cast("bigint").cast("string"), "url").alias("value")).write.text(f"{legacy}/{dc}/page")
    batch.import_legacy_dims(spark, legacy, wh.root)
    return wh


def import_users(spark, sf_dir):
    """Subscribers after an import into a dictionary in use."""
    return tables.dim_user(spark, _import(spark, sf_dir)).drop("batch_id")


def import_pages(spark, sf_dir):
    """Pages after an import into a dictionary in use."""
    return tables.dim_page(spark, _import(spark, sf_dir)).drop("batch_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    second_run_reads_nothing, rerun_totals, landing_paths, landing_rejects, two_checkpoints,
    descriptor_fields, descriptor_problems, catalog_versions, import_users, import_pages,
    touched_file, batch_and_stream_one_landing, odd_file_names, odd_times, half_written_batch, late_descriptor,
    ids_two_writers, dim_compacted, usage_stream, archived_landing)}
