"""One batch run over landing files (the whole job of section 3.1).

register formats -> read and tag lines -> parse (one pass; good and
quarantined rows land in one table, split by ``status``) -> read the
standard rows back -> extend the dictionaries -> enrich -> write the
enriched rows, their text form and hourly usage.

Every step reads what the previous step wrote, so a lost executor only
repeats the step it was in, and re-running a batch id replaces its own
output partitions and adds no dictionary rows.

Each data file belongs to one batch or micro-batch. A file is known by its place
and name below the landing and by its lines, not by its time: one that is
touched or sent again is not taken again. A run first writes down the files it
takes (``ingested``); later runs take only files that no batch has, after
finishing any batch that was broken off. So a file's lines are stored exactly
once. A file whose lines changed under an old name is another file: landings
are to move files into place when they are complete.

A batch is opened before its first output and closed after its last
(:mod:`..sources.batches`); :func:`output` reads whole batches only.

A descriptor that arrives late, after lines it is for, is brought in by
:func:`apply_late_descriptors`: only lines whose version it changes are parsed anew.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, late, metrics, standardize
from ..operators.dims import page_urls, user_keys
from ..operators.joins import anti_join
from ..operators.migrate import settle_ids
from ..operators.partitioning import spread
from ..operators.staging import staged
from ..session import checkpoint_dir
from ..sources import catalog, dictionary, tables
from ..sources.batches import Batches
from ..sources.landing import (identities, list_files, place_of, plain_path, read_files, read_partitioned_lines, tag_lines)
from ..sources.tables import Warehouse

PARTITIONS = ["dc", "datatype", "batch_id"]
RECORD_PARTITIONS = ["status", *PARTITIONS]


@contextmanager
def _step(spark: SparkSession, name: str):
    """Label the jobs of one step (visible in the event log and job listings)."""
    sc = spark.sparkContext
    sc.setJobDescription(f"cdrflow: {name}")
    try:
        yield
    finally:
        sc.setJobDescription(None)


@dataclass
class BatchResult:
    batch_id: int
    standard_rows: int
    rejected: dict[str, int]
    new_users: int
    new_pages: int


def _store(spark: SparkSession, parsed: DataFrame, wh: Warehouse, batch_id: int):
    """Write parsed lines, good and quarantined, in one pass; the stored schema.

    The line itself is kept with good rows too, for late descriptors; whoever
    reads standard rows doesn't read that column.
    """
    out = parsed.withColumn("status", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("rejected")))
    tables.write_batch(out, wh.records, RECORD_PARTITIONS, batch_id)
    return out.schema


def parse_and_store(spark: SparkSession, lines: DataFrame, wh: Warehouse, batch_id: int):
    """Parse tagged lines and write them. Returns the schema of the stored records."""
    known = catalog.formats(spark, wh)
    newest = known.agg(F.max("registered_at").alias("registered_at")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    tables.write_batch(newest, wh.parsed_with, ["batch_id"], batch_id)
    return _store(spark, standardize.parse_by_formats(lines, known), wh, batch_id)


def records(spark: SparkSession, wh: Warehouse, batch_id: int, schema) -> DataFrame:
    """All stored lines of one batch, good or not."""
    return tables.read_batch(spark, wh.records, RECORD_PARTITIONS, batch_id, schema)


def extend_dims(spark: SparkSession, std: DataFrame, wh: Warehouse, batch_id: int) -> tuple[int, int]:
    """Append this batch's new subscribers and pages; (new users, new pages)."""
    return (dictionary.users(spark, wh).extend(user_keys(std), batch_id),
            dictionary.pages(spark, wh).extend(page_urls(std), batch_id))


def enrich_and_store(spark: SparkSession, std: DataFrame, wh: Warehouse, batch_id: int,
                     text: bool = True, cluster_output: bool = False) -> None:
    """Enrich and write. ``cluster_output`` range-partitions the rows by
    (dc, datatype, batch, row) first -- one more shuffle -- so each task
    writes about one folder (fewer, larger files); a hot data centre is still
    split over many tasks because row ids are distinct."""
    rows = enrich.enrich(std, dictionary.users(spark, wh).layers(), dictionary.pages(spark, wh).layers())
    if cluster_output:
        rows = rows.repartitionByRange(*PARTITIONS, "row_id")
    tables.write_batch(rows, wh.enriched, PARTITIONS, batch_id)
    if text:
        stored = tables.read_batch(spark, wh.enriched, PARTITIONS, batch_id, rows.schema)
        tables.write_batch(stored.select(*PARTITIONS, enrich.text_line().alias("value")), wh.text, PARTITIONS, batch_id, "text")
    usage = metrics.bucket_counts(std, keys=["dc", "datatype", "batch_id", "op",
                                             "service_code", "bearer"])
    tables.write_batch(usage, wh.usage, PARTITIONS, batch_id)


def _finish(spark: SparkSession, wh: Warehouse, batch_id: int, schema, text: bool, cluster_output: bool) -> BatchResult:
    """Everything behind the stored records of an open batch; closes it."""
    stored = records(spark, wh, batch_id, schema)
    with _step(spark, "count records"):
        # one small aggregation: rows per status and reason (at most a handful)
        summary = stored.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n")).collect()
    n_std = sum(r["n"] for r in summary if r["status"] == "ok")
    rejected = {r["reason"]: r["n"] for r in summary if r["status"] == "rejected"}
    std = standardize.good_rows(stored.where(F.col("status") == "ok"))
    new_u = new_p = 0
    if n_std:  # P13: an empty batch brings nothing to the dictionaries; an earlier run's outputs go
        with _step(spark, "extend dictionaries"):
            new_u, new_p = extend_dims(spark, std, wh, batch_id)
    with _step(spark, "enrich and store"):
        enrich_and_store(spark, std, wh, batch_id, text, cluster_output)
    Batches(spark, wh).close(batch_id)
    return BatchResult(batch_id, n_std, rejected, new_u, new_p)


def process_lines(spark: SparkSession, lines: DataFrame, wh: Warehouse, batch_id: int,
                  text: bool = True, cluster_output: bool = False) -> BatchResult:
    """Everything after the scan, for tagged lines of one batch."""
    checkpoint_dir(spark)
    Batches(spark, wh).open(batch_id)
    with _step(spark, "parse and store records"):
        schema = parse_and_store(spark, lines, wh, batch_id)
    return _finish(spark, wh, batch_id, schema, text, cluster_output)


def output(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame | None:
    """The rows of whole batches of ``records``, ``enriched``, ``usage`` or ``text``."""
    if name != "text":
        return Batches(spark, wh).read(getattr(wh, name))
    whole = Batches(spark, wh).whole(F.col("batch_id").cast("bigint"))
    return spark.read.text(wh.text).where(whole) if Batches(spark, wh).log.last() else None


def _clock() -> int:
    return int(time.time() * 1000)


LEDGER = "source_file string, name string, content string, length bigint, modified bigint, taken boolean, stream boolean, batch_id bigint"


def _ledger(spark: SparkSession, wh: Warehouse, batch_id: int | None = None) -> DataFrame:
    if batch_id is not None:
        return tables.read_batch(spark, wh.ingested, ["batch_id"], batch_id, LEDGER)
    return tables.read_or_empty(spark, wh.ingested, LEDGER)


def _take(files: DataFrame, wh: Warehouse, batch_id: int, stream: bool = False) -> DataFrame:
    """Write down ``files`` (source_file, name, content, length, modified) for ``batch_id``,
    with whether it takes them: not those whose lines another batch or another
    file of this one already has under the same name."""
    spark = files.sparkSession
    elsewhere = _ledger(spark, wh).where((F.col("batch_id") != batch_id) & F.col("taken"))
    new = anti_join(files.select("name", "content").distinct(), elsewhere.select("name", "content").distinct(), ["name", "content"])
    first = files.groupBy("name", "content").agg(F.min("source_file").alias("source_file")).join(new, ["name", "content"])
    marked = files.join(first.select("source_file").withColumn("taken", F.lit(True)), "source_file", "left").withColumns(
        {"taken": F.coalesce("taken", F.lit(False)), "stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
    tables.write_batch(marked.select("source_file", "name", "content", "length", "modified", "taken", "stream", "batch_id").checkpoint(eager=True),
                       wh.ingested, ["batch_id"], batch_id)
    return _ledger(spark, wh, batch_id).where("taken")


def _take_files(spark: SparkSession, wh: Warehouse, paths: str | list[str], root: str, batch_id: int) -> list[str]:
    """The paths of the files of ``batch_id``: those it had when it ran before, else
    those that no batch has.

    Files that the ledger has with their length and time aren't read again to
    know them. The list is as long as the batch has files, which the
    driver lists to read them anyway.
    """
    known = _ledger(spark, wh).where(F.col("batch_id") != batch_id).select("source_file", "length", "modified").distinct()
    files, own = list_files(spark, paths), _ledger(spark, wh, batch_id).where("taken")
    if not own.isEmpty():
        files = files.join(own.select("source_file"), "source_file", "left_semi")
    files = files.join(known, ["source_file", "length", "modified"], "left_anti").checkpoint(eager=True)
    lines = read_files(spark, [r["path"] for r in files.select("path").collect()])
    empty = F.concat_ws("/", place_of(F.col("source_file"), root))
    found = (files.join(identities(lines, root), "source_file", "left")
             .withColumns({"name": F.coalesce("name", empty), "content": F.coalesce("content", F.lit("0"))}))
    taken = _take(found.drop("path"), wh, batch_id)
    return [r["path"] for r in taken.join(files.select("source_file", "path"), "source_file").select("path").orderBy("path").collect()]


def _unfinished(spark: SparkSession, wh: Warehouse) -> list[int]:
    """Batches that were begun and aren't whole; streams finish their own."""
    begun = _ledger(spark, wh).where(~F.col("stream")).select("batch_id").distinct()
    return sorted(r["batch_id"] for r in begun.where(~Batches(spark, wh).whole()).collect())


def run_batch(spark: SparkSession, landing_root: str, warehouse: str, batch_id: int,
              data_paths: str | list[str] | None = None, text: bool = True,
              partitioned: bool = False, descriptor_root: str | None = None,
              cluster_output: bool = False) -> BatchResult:
    """Register descriptors under ``descriptor_root`` (default: the landing)
    and process the landing's data files (or just those under ``data_paths``)
    that no other batch has taken as batch ``batch_id``. ``partitioned`` reads
    a ``dc=/datatype=/op=`` landing written by another Spark job (its
    descriptors then live apart).

    A batch that was broken off is finished first, with the files it had taken.
    One that fails again is written down (``stuck_batches``), stays
    open, and doesn't keep later ones from running. Running a batch id again
    takes the files it had, as they are now, and no others.
    """
    wh = Warehouse(warehouse)
    with _step(spark, "register formats"):
        catalog.register(spark, descriptor_root or landing_root, wh, _clock())

    def run(own: int, paths: list[str]) -> BatchResult:
        if partitioned and paths:
            mine = spark.createDataFrame([(plain_path(p),) for p in paths], "_path string")
            lines = read_partitioned_lines(spark, landing_root)
            lines = lines.join(mine, F.concat_ws("/", F.lit(""), F.array_join(place_of(F.col("source_file"), "/"), "/")) == mine["_path"], "left_semi")
        else:
            lines = read_files(spark, paths)
        return process_lines(spark, tag_lines(spread(lines), own, landing_root), wh, own, text, cluster_output)

    for broken_off in _unfinished(spark, wh):
        if broken_off != batch_id:
            held = _ledger(spark, wh, broken_off).where("taken").select("source_file")
            files = list_files(spark, landing_root).join(held, "source_file", "left_semi")
            try:
                run(broken_off, [r["path"] for r in files.select("path").orderBy("path").collect()])
            except Exception as e:  # whatever it is, it is that batch's
                failed = [(broken_off, _clock(), str(e)[:2000])]
                tables.append(spark.createDataFrame(failed, "batch_id bigint, at bigint, error string"), wh.stuck)
    return run(batch_id, _take_files(spark, wh, data_paths or landing_root, landing_root, batch_id))


def apply_late_descriptors(spark: SparkSession, descriptor_root: str, warehouse: str) -> list[BatchResult]:
    """Register the descriptors under ``descriptor_root`` and bring every whole batch
    to what it would be had they been there from the start.

    Per batch, only lines are parsed again whose version may change: those that
    were rejected, and good rows in the times that the new versions take over
    (:mod:`..operators.late`). Batches without such lines aren't touched.
    """
    wh = Warehouse(warehouse)
    catalog.register(spark, descriptor_root, wh, _clock())
    known = catalog.formats(spark, wh)
    parsed_with = tables.read_or_empty(spark, wh.parsed_with, "registered_at bigint, batch_id bigint")
    newest = known.agg(F.max("registered_at")).first()[0]
    behind = parsed_with.where(Batches(spark, wh).whole() & (F.coalesce("registered_at", F.lit(-1)) < F.lit(newest))).collect()
    results = []
    for batch_id, before in sorted((r["batch_id"], r["registered_at"]) for r in behind):
        schema = tables.read_table(spark, wh.records).schema
        stored = records(spark, wh, batch_id, schema)
        new = late.changed_lines(stored, known, -1 if before is None else before)
        if new is None:
            continue
        Batches(spark, wh).open(batch_id)
        with _step(spark, "parse lines of late descriptors"):
            lines, kept = new
            parsed = standardize.parse_by_formats(lines, known)
            merged = kept.drop("status").unionByName(parsed.select(*[c for c in schema.names if c != "status"]))
            # What is being replaced is being read: the new rows are stored first.
            merged = staged(merged, "late-records")
            _store(spark, merged, wh, batch_id)
            tables.write_batch(spark.createDataFrame([(newest, batch_id)], "registered_at bigint, batch_id bigint"), wh.parsed_with, ["batch_id"], batch_id)
        results.append(_finish(spark, wh, batch_id, schema, True, False))
    return results


def process_stream_batch(spark: SparkSession, raw: DataFrame, wh: Warehouse, batch_id: int,
                         landing_root: str | None = None, descriptor_root: str | None = None) -> BatchResult:
    """A micro-batch of untagged lines (``line``, ``source_file``); files that a batch
    or an earlier micro-batch already has are left out."""
    if descriptor_root or landing_root:
        catalog.register(spark, descriptor_root or landing_root, wh, _clock())
    files = identities(raw, landing_root).withColumns({c: F.lit(None).cast("bigint") for c in ("length", "modified")})
    taken = _take(files.checkpoint(eager=True), wh, batch_id, stream=True).select("source_file")
    lines = raw.join(F.broadcast(taken), "source_file", "left_semi")  # as many rows as the micro-batch has files
    return process_lines(spark, tag_lines(lines, batch_id, landing_root), wh, batch_id)


@dataclass
class ImportResult:
    users: int
    pages: int
    unreadable: int


def import_legacy_dims(spark: SparkSession, legacy_root: str, warehouse: str) -> ImportResult:
    """Append the old text dictionaries ``<root>/<dc>/user/*`` and
    ``<root>/<dc>/page/*`` to the dictionary tables: keys not yet known only,
    with ids settled per data centre against those in use. Rows whose id is
    no number are counted and left out."""
    wh = Warehouse(warehouse)
    added, unreadable = [], 0
    for read, held in ((tables.import_text_dim_user(spark, f"{legacy_root}/*/user"), dictionary.users(spark, wh)),
                       (tables.import_text_dim_page(spark, f"{legacy_root}/*/page"), dictionary.pages(spark, wh))):
        unreadable += read.where(F.col(held.id_col).isNull()).count()
        while True:
            at = held.snapshot()
            known = held.rows(at)
            fresh = settle_ids(anti_join(read, known, held.key), held.key, held.id_col, taken=known)
            if held.commit(staged(fresh.select(*held.schema.names), "imported"), at):
                break
        added.append(held.snapshot().rows_total - at.rows_total)
    return ImportResult(*added, unreadable)
