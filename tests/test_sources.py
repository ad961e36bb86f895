"""S08, S09 legacy dictionary text, P13 empty batches, S02 name filter."""

import os

from cdrflow.plans.batch import run_batch
from cdrflow.sources.tables import import_text_dim_page, import_text_dim_user

import cdr_fixtures as fx


def test_legacy_dictionary_text_keeps_empty_fields(spark, tmp_dir):
    users = os.path.join(tmp_dir, "user.txt")
    with open(users, "w") as fh:
        fh.write(f"1;idc;alphanet;{fx.DORA};;\n2;idc;gammatel;{fx.EMIL};{fx.IMSI[fx.EMIL]};\n\n")
    rows = {r["user_id"]: r for r in import_text_dim_user(spark, users, "idc").collect()}
    assert rows[1]["imsi"] == "" and rows[1]["imei"] == "" and rows[1]["op"] == "alphanet"
    assert rows[2]["imsi"] == fx.IMSI[fx.EMIL]
    pages = os.path.join(tmp_dir, "page.txt")
    with open(pages, "w") as fh:
        fh.write("9;file:/a.xml\n10;http://h.com/x;y\n")
    got = {r["page_id"]: r["url"] for r in import_text_dim_page(spark, pages, "idc").collect()}
    assert got == {9: "file:/a.xml", 10: "http://h.com/x;y"}


def test_batch_with_no_data_files(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    d = os.path.join(landing, "idc", "webcdr")
    os.makedirs(d)
    with open(os.path.join(d, "data_format-x-alphanet-2012.properties"), "w") as fh:
        fh.write(fx.descriptor(fx.START_1, ";"))
    res = run_batch(spark, landing, os.path.join(tmp_dir, "wh"), batch_id=1)
    assert (res.standard_rows, res.new_users, res.new_pages) == (0, 0, 0)
    assert res.rejected == {}


def test_import_legacy_dims_settles_ids(spark, tmp_dir):
    from cdrflow.plans.batch import ImportResult, import_legacy_dims
    from cdrflow.sources import tables
    from cdrflow.sources.tables import Warehouse
    root = os.path.join(tmp_dir, "dim")
    for sub in ("user", "page"):
        os.makedirs(os.path.join(root, "idc", sub))
    with open(os.path.join(root, "idc", "user", "1000"), "w") as fh:
        fh.write(f"1;idc;alphanet;{fx.DORA};;\n2;idc;gammatel;{fx.EMIL};{fx.IMSI[fx.EMIL]};\n")
    with open(os.path.join(root, "idc", "page", "1000"), "w") as fh:  # url under two ids, id 10 reused
        fh.write("9;file:/a.xml\n10;file:/b.xml\n10;file:/c.xml\n11;file:/a.xml\n")
    wh = os.path.join(tmp_dir, "wh")
    assert import_legacy_dims(spark, root, wh) == ImportResult(2, 3, 0)
    pages = {r["url"]: r["page_id"] for r in tables.dim_page(spark, Warehouse(wh)).collect()}
    assert pages == {"file:/a.xml": 9, "file:/b.xml": 10, "file:/c.xml": 11}
    users = {r["msisdn"]: (r["user_id"], r["imsi"], r["imei"]) for r in tables.dim_user(spark, Warehouse(wh)).collect()}
    assert users[fx.DORA] == (1, "", "")
    assert import_legacy_dims(spark, root, wh) == ImportResult(0, 0, 0)  # idempotent


def test_import_into_a_live_dictionary_keeps_ids_unique(spark, tmp_dir):
    from cdrflow.plans.batch import import_legacy_dims, run_batch
    landing = fx.build_landing(os.path.join(tmp_dir, "landing"))
    wh = os.path.join(tmp_dir, "wh")
    run_batch(spark, landing, wh, batch_id=1)
    legacy = os.path.join(tmp_dir, "legacy", "idc")
    os.makedirs(os.path.join(legacy, "user"))
    os.makedirs(os.path.join(legacy, "page"))
    with open(os.path.join(legacy, "user", "u.txt"), "w") as fh:
        fh.write("1;idc;alphanet;+1;;\n2;idc;alphanet;+2;;\nx;idc;alphanet;+3;;\n90;idc;alphanet;+4;;\n")
    with open(os.path.join(legacy, "page", "p.txt"), "w") as fh:
        fh.write("1;file:/old.xml\n")
    got = import_legacy_dims(spark, os.path.join(tmp_dir, "legacy"), wh)
    assert (got.users, got.pages, got.unreadable) == (3, 1, 1)
    for t, c, n in (("dim_user", "user_id", fx.USERS + 3), ("dim_page", "page_id", fx.PAGES + 1)):
        rows = [(r["dc"], r[c]) for r in spark.read.parquet(f"{wh}/{t}").collect()]
        assert len(rows) == len(set(rows)) == n
    users = {r["msisdn"]: r["user_id"] for r in spark.read.parquet(f"{wh}/dim_user").collect()}
    assert users["+4"] == 90 and users["+1"] > 90


def test_catalog_versions_and_problems(spark, tmp_dir):
    """Going back to an earlier content is a new version; refused descriptors are kept once."""
    from cdrflow.sources import catalog
    from cdrflow.sources.tables import Warehouse, read_table
    d = os.path.join(tmp_dir, "landing", "idc", "webcdr")
    os.makedirs(d)
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    with open(os.path.join(d, "bad.properties"), "w") as fh:
        fh.write("delimiter=;\n")
    for clock, delimiter in ((10, ";"), (20, "|"), (30, "|"), (40, ";")):
        with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
            fh.write(fx.descriptor(fx.START_1, delimiter))
        catalog.register(spark, os.path.join(tmp_dir, "landing"), wh, clock)
    rows = sorted((r["registered_at"], r["delimiter"]) for r in read_table(spark, wh.formats).collect())
    assert rows == [(10, ";"), (20, "|"), (40, ";")]
    assert catalog.versions(spark, wh).first()["versions"][-1]["registered_at"] == 40
    assert [r["problem"] for r in read_table(spark, wh.format_problems).collect()] == ["bad_descriptor_name"]


def test_many_rows_are_spread_over_more_tasks_than_cores(spark, monkeypatch, tmp_dir):
    """The feed's tasks take TASK_ROWS at most, about, however few splits its events have."""
    from pyspark.sql import functions as F
    from cdrflow.operators import partitioning
    from cdrflow.plans import feed
    (spark.range(2_000).select(F.col("id").alias("event_id"), F.lit("2024-01-05 00:00:00").cast("timestamp_ntz").alias("ts"), (F.col("id") % 50).alias("user_id"),
                               F.lit("view").alias("event_type"), F.lit(1.5).alias("value")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet"))
    spark.createDataFrame([(0, "http://a.example/"), (1, "https://b.example/")], "page_id bigint, url string").write.parquet(f"{tmp_dir}/pages.parquet")
    expected = sorted(r["line"] for r in feed.cdr_feed(spark, tmp_dir).collect())
    monkeypatch.setattr(partitioning, "TASK_ROWS", 100)
    lines = feed.cdr_feed(spark, tmp_dir)
    assert lines.rdd.getNumPartitions() == 20
    sizes = [r["n"] for r in lines.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 200 and sorted(r["line"] for r in lines.collect()) == expected
