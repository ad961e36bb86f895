"""End to end on a landing tree: S01-S11, P14, J01-J05, A01-A05, U01, laws."""

import os
import re

from pyspark.sql import functions as F

from cdrflow.plans.batch import run_batch
from cdrflow.schema import URL_PATTERN
from cdrflow.sources import tables
from cdrflow.sources.tables import Warehouse

import cdr_fixtures as fx


def test_run_batch_end_to_end(spark, tmp_dir):
    landing = fx.build_landing(os.path.join(tmp_dir, "landing"))
    wh_root = os.path.join(tmp_dir, "wh")
    res = run_batch(spark, landing, wh_root, batch_id=1)
    assert res.standard_rows == fx.STANDARD_ROWS
    assert res.rejected == fx.REJECTED
    assert res.new_users == fx.USERS and res.new_pages == fx.PAGES

    wh = Warehouse(wh_root)
    users = {(r["op"], r["msisdn"]): r["user_id"] for r in tables.dim_user(spark, wh).collect()}
    assert users[("alphanet", fx.ANNA)] == 1
    assert users[("alphanet", fx.DORA)] == 4
    assert users[("gammatel", fx.FAYE)] == 6

    pages = {r["url"]: r["page_id"] for r in tables.dim_page(spark, wh).collect()}
    assert sorted(pages.values()) == list(range(1, fx.PAGES + 1))
    assert "http://example.com/a" in pages and "https://example.org/p+q/x" in pages

    enriched = spark.read.parquet(wh.enriched).where("batch_id = 1")
    rows = {(r["user_id"], r["session_time"]): r for r in enriched.collect()}
    assert len(rows) == fx.STANDARD_ROWS
    post = rows[(users[("alphanet", fx.BERT)], fx.DAY + 150)]["page_ids"]
    assert post == [pages[f"{fx.MENU}/news.xml"], pages[f"{fx.MENU}/news.xml#p1"],
                    pages[f"{fx.MENU}/news.xml#p12"]]
    repeated = rows[(users[("alphanet", fx.DORA)], fx.DAY + 333)]["page_ids"]
    assert repeated == [pages["http://example.com/a"]] * 2
    empty = rows[(users[("alphanet", fx.DORA)], fx.DAY + 402)]
    assert empty["page_ids"] == [] and empty["page_sent"] is None and empty["extra"] is None
    eleven = rows[(users[("gammatel", fx.FAYE)], fx.DAY + 95)]["page_ids"]
    assert eleven == [pages[u] for u in fx.ELEVEN_PAGES]
    # law: list length equals page_sent where page_sent is a number
    for r in rows.values():
        if r["page_sent"] is not None:
            assert len(r["page_ids"]) == int(r["page_sent"])

    # law: standard + quarantined = non-empty data lines
    recs = spark.read.parquet(wh.records).where("batch_id = 1")
    assert recs.count() == fx.STANDARD_ROWS + sum(fx.REJECTED.values())

    # text export: 12 fields per line
    text = spark.read.text(wh.text).collect()
    assert len(text) == fx.STANDARD_ROWS
    assert all(len(r["value"].split(";")) == 12 for r in text)

    # hits per page by brute force
    brute = {}
    for line in fx.ALPHANET_1 + fx.ALPHANET_2 + fx.GAMMATEL:
        for u in re.findall(URL_PATTERN, line):
            brute[u] = brute.get(u, 0) + 1
    hits = (enriched.select(F.explode("page_ids").alias("page_id")).groupBy("page_id").count())
    by_id = {r["page_id"]: r["count"] for r in hits.collect()}
    assert {u: by_id[pages[u]] for u in brute} == brute

    usage = spark.read.parquet(wh.usage).where("batch_id = 1")
    assert usage.agg(F.sum("sessions")).first()[0] == fx.STANDARD_ROWS

    # law: a re-run of the same batch replaces its output and adds no dictionary rows
    res2 = run_batch(spark, landing, wh_root, batch_id=1)
    assert (res2.new_users, res2.new_pages) == (0, 0)
    assert spark.read.parquet(wh.enriched).where("batch_id = 1").count() == fx.STANDARD_ROWS
    # law: a later batch finds no file that isn't taken, and keeps the ids
    res3 = run_batch(spark, landing, wh_root, batch_id=2)
    assert (res3.standard_rows, res3.rejected, res3.new_users, res3.new_pages) == (0, {}, 0, 0)
    assert spark.read.parquet(wh.records).count() == fx.STANDARD_ROWS + sum(fx.REJECTED.values())
    assert tables.dim_user(spark, wh).count() == fx.USERS
    assert {r["url"]: r["page_id"] for r in tables.dim_page(spark, wh).collect()} == pages
    # the catalog registered each descriptor once, with its flattened fields
    assert spark.read.parquet(wh.formats).count() == 3
    assert spark.read.parquet(wh.format_fields).count() == 3 * 14


def _stored(spark, wh):
    rows = tables.read_table(spark, wh.records)
    if rows is None:  # no folder is left
        return []
    return sorted((r["status"], r["dc"], r["msisdn"], r["session_time"], r["line"])
                  for r in rows.select("status", "dc", "msisdn", "session_time", "line").collect())


def test_rerun_replaces_the_whole_batch(spark, tmp_dir):
    """Rejected lines become good with their descriptor; a removed file's lines go."""
    landing = fx.build_landing(os.path.join(tmp_dir, "landing"))
    d = os.path.join(landing, "idc", "webcdr")
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    run_batch(spark, landing, wh.root, batch_id=5)
    os.remove(os.path.join(d, "CDR_bad_name"))
    os.remove(os.path.join(d, "notes.txt"))
    with open(os.path.join(d, "data_format-x-zetanet-1.properties"), "w") as fh:
        fh.write(fx.descriptor(fx.START_1, ";"))
    res = run_batch(spark, landing, wh.root, batch_id=5)
    assert res.rejected == {} and res.standard_rows == fx.STANDARD_ROWS + len(fx.UNKNOWN)
    assert len(_stored(spark, wh)) == res.standard_rows
    for name in os.listdir(d):
        if not name.startswith("data_format"):
            os.remove(os.path.join(d, name))
    res = run_batch(spark, landing, wh.root, batch_id=5)
    assert res.standard_rows == 0 and _stored(spark, wh) == []
    for path in (wh.enriched, wh.usage, wh.text):
        assert not any(files for _, _, files in os.walk(path) if any(f.startswith("part-") for f in files))


def test_files_belong_to_one_batch_and_broken_off_batches_are_finished(spark, tmp_dir, monkeypatch):
    from cdrflow.plans import batch
    landing = fx.build_landing(os.path.join(tmp_dir, "landing"))
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    whole = batch.enrich_and_store
    monkeypatch.setattr(batch, "enrich_and_store", lambda *a, **b: 1 / 0)
    try:
        run_batch(spark, landing, wh.root, batch_id=1)
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(batch, "enrich_and_store", whole)
    late = os.path.join(landing, "idc", "webcdr", "CDR_gammatel_20240305_080000_h2_0009")
    fx.write(late, [fx.record(fx.EMIL, fx.DAY + 90_000, pages="0")])
    res = run_batch(spark, landing, wh.root, batch_id=2)
    assert res.standard_rows == 1
    got = tables.read_table(spark, wh.enriched).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in got} == {1: fx.STANDARD_ROWS, 2: 1}


def test_names_places_and_files_are_kept(spark, tmp_dir):
    """Numeric data centres stay text; a file of any name is read; one at another depth is quarantined."""
    landing = os.path.join(tmp_dir, "landing")
    line = fx.record(fx.EMIL, fx.DAY, pages="0")
    for dc in ("001", "1"):
        d = os.path.join(landing, dc, "webcdr")
        os.makedirs(os.path.join(d, "deeper"))
        with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
            fh.write(fx.descriptor(fx.START_1, ";"))
        fx.write(os.path.join(d, "XCDR_alphanet_20240304_080000_h1_1"), [line])
        fx.write(os.path.join(d, "deeper", "CDR_alphanet_20240304_080000_h1_2"), [line])
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    res = run_batch(spark, landing, wh.root, batch_id=1)
    assert res.standard_rows == 2 and res.rejected == {"bad_path": 2} and res.new_users == 2
    assert {r["dc"] for r in tables.dim_user(spark, wh).collect()} == {"001", "1"}
    assert {r["dc"] for r in tables.read_table(spark, wh.enriched).collect()} == {"001", "1"}


def test_partitioned_landing(spark, tmp_dir):
    """A ``dc=/datatype=/op=`` landing of another Spark job; a second run takes no file."""
    landing, formats = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "formats")
    rows = [("007", "webcdr", "alphanet", line) for line in fx.ALPHANET_1] + [("idc", "webcdr", "zetanet", line) for line in fx.UNKNOWN]
    spark.createDataFrame(rows, "dc string, datatype string, op string, value string").write.partitionBy("dc", "datatype", "op").text(landing)
    d = os.path.join(formats, "007", "webcdr")
    os.makedirs(d)
    with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
        fh.write(fx.descriptor(fx.START_1, ";"))
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    res = run_batch(spark, landing, wh.root, 1, partitioned=True, descriptor_root=formats)
    assert res.standard_rows == len(fx.ALPHANET_1) and res.rejected == {"unknown_operator": 2}
    assert {r["dc"] for r in tables.dim_user(spark, wh).collect()} == {"007"}
    res = run_batch(spark, landing, wh.root, 2, partitioned=True, descriptor_root=formats)
    assert res.standard_rows == 0 and res.rejected == {}
