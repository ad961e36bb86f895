"""Files are known by place, name and lines; no file stops later batches; late descriptors."""

import os
import shutil

from pyspark.sql import functions as F

from cdrflow.operators import late
from cdrflow.plans import batch
from cdrflow.plans.batch import apply_late_descriptors, output, run_batch
from cdrflow.sources import tables
from cdrflow.sources.tables import Warehouse
from cdrflow.streaming.arrival import run_available

import cdr_fixtures as fx


def landing_with(tmp_dir, name, lines, start=fx.START_1, delimiter=";"):
    d = os.path.join(tmp_dir, "landing", "idc", "webcdr")
    os.makedirs(d, exist_ok=True)
    if start:
        with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
            fh.write(fx.descriptor(start, delimiter))
    fx.write(os.path.join(d, name), lines)
    return os.path.join(tmp_dir, "landing"), d


def stored(spark, wh):
    return sorted((r["batch_id"], r["reason"] or "", r["line"]) for r in output(spark, wh, "records").collect())


def test_touched_and_sent_again(spark, tmp_dir):
    """New times and a new order of lines change nothing; other lines under the same name, or the same lines under another, do."""
    name = "CDR_alphanet_20240304_080000_h[1]_{a}?* 1"
    root, d = landing_with(tmp_dir, name, fx.ALPHANET_1[:2])
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    assert run_batch(spark, root, wh.root, 1).standard_rows == 2
    os.utime(os.path.join(d, name), (2_000_000_000, 2_000_000_000))
    assert run_batch(spark, root, wh.root, 2).standard_rows == 0
    fx.write(os.path.join(d, name), fx.ALPHANET_1[1::-1])
    assert run_batch(spark, root, wh.root, 3).standard_rows == 0
    run_available(spark, root, wh.root, os.path.join(tmp_dir, "ckpt"))  # a stream of the same landing
    assert len(stored(spark, wh)) == 2
    shutil.copy(os.path.join(d, name), os.path.join(d, "CDR_alphanet_20240304_080000_h1_2"))
    fx.write(os.path.join(d, name), fx.ALPHANET_1[:1])
    run_available(spark, root, wh.root, os.path.join(tmp_dir, "ckpt"))
    assert run_batch(spark, root, wh.root, 4).standard_rows in (0, 1)  # the stream keeps to paths it hasn't seen
    assert len(stored(spark, wh)) == 5


def test_no_file_and_no_folder(spark, tmp_dir):
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    root, d = landing_with(tmp_dir, "CDR_alphanet_20240304_080000_h1_1", fx.ALPHANET_1[:2])
    run_batch(spark, root, wh.root, 1)
    res = run_batch(spark, os.path.join(tmp_dir, "nowhere"), wh.root, 2)
    assert (res.standard_rows, res.rejected) == (0, {})
    assert len(stored(spark, wh)) == 2


def test_a_batch_that_fails_again_keeps_none_from_running(spark, tmp_dir, monkeypatch):
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    root, d = landing_with(tmp_dir, "CDR_alphanet_20240304_080000_h1_1", fx.ALPHANET_1[:2])
    whole = batch.enrich_and_store
    monkeypatch.setattr(batch, "enrich_and_store", lambda s, std, w, own, *a: 1 / 0 if own == 1 else whole(s, std, w, own, *a))
    try:
        run_batch(spark, root, wh.root, 1)
    except ZeroDivisionError:
        pass
    landing_with(tmp_dir, "CDR_alphanet_20240304_090000_h1_2", fx.ALPHANET_1[2:4])
    assert run_batch(spark, root, wh.root, 2).standard_rows == 2
    stuck = spark.read.parquet(wh.stuck).collect()
    assert [(r["batch_id"], "division" in r["error"]) for r in stuck] == [(1, True)]
    assert {b for b, _, _ in stored(spark, wh)} == {2}  # the broken one shows nowhere
    monkeypatch.setattr(batch, "enrich_and_store", whole)
    assert run_batch(spark, root, wh.root, 3).standard_rows == 0
    assert [b for b, _, _ in stored(spark, wh)] == [1, 1, 2, 2]
    # an old batch takes no file that arrived since
    landing_with(tmp_dir, "CDR_alphanet_20240304_100000_h1_3", fx.ALPHANET_1[4:5])
    assert run_batch(spark, root, wh.root, 1).standard_rows == 2


def test_late_descriptors(spark, tmp_dir):
    """As with all descriptors from the start, and only lines that may change are parsed again."""
    late_name = "data_format-x-alphanet-2.properties"
    wh, both = Warehouse(os.path.join(tmp_dir, "wh")), Warehouse(os.path.join(tmp_dir, "wh2"))
    root = fx.build_landing(os.path.join(tmp_dir, "landing"))
    d, later = os.path.join(root, "idc", "webcdr"), os.path.join(tmp_dir, "later", "idc", "webcdr")
    os.makedirs(later)
    shutil.move(os.path.join(d, late_name), os.path.join(later, late_name))
    run_batch(spark, root, wh.root, 1)
    assert run_batch(spark, root, wh.root, 1).standard_rows == fx.STANDARD_ROWS - len(fx.ALPHANET_2)
    [done] = apply_late_descriptors(spark, os.path.join(tmp_dir, "later"), wh.root)
    assert done.standard_rows == fx.STANDARD_ROWS
    assert apply_late_descriptors(spark, os.path.join(tmp_dir, "later"), wh.root) == []
    shutil.copy(os.path.join(later, late_name), os.path.join(d, late_name))
    run_batch(spark, root, both.root, 1)
    for name, columns in (("records", ["status", "dc", "op", "msisdn", "session_time", "urls", "format_name", "reason", "line"]),
                          ("enriched", ["session_time", "subscription", "page_sent", "extra"]), ("text", ["dc"]), ("usage", ["op", "bucket", "sessions"])):
        a, b = (sorted(map(str, output(spark, w, name).select(*columns).collect())) for w in (wh, both))
        assert a == b, name


def test_takeovers(spark):
    def version(op, name, start, registered, fmt="", delimiter=";"):
        return ("a", "w", op, start, registered, name, delimiter, "UTC", ((3, "INT", fmt),), None)
    formats = spark.createDataFrame(
        [version("x", "1", 100, 1), version("x", "2", 200, 5), version("x", "3", 300, 1), version("x", "4", 300, 6),
         version("y", "1", 100, 1), version("z", "1", 50, 1), version("z", "2", 80, 5, delimiter="|")],
        "dc string, datatype string, op string, start_time long, registered_at long, format_name string, delimiter string, timezone string,"
        " layout struct<session_time: struct<pos: int, type: string, format: string>>, problem string")
    got = {r["op"]: r["times"] and sorted(map(tuple, r["times"])) for r in late.takeovers(formats, 4).collect()}
    assert got == {"x": [(200, 299), (300, late.FOREVER)], "z": None}  # z: the time is read in two ways
    assert late.takeovers(formats, 6).collect() == []
    rows = [("ok", "x", 250, "l1"), ("ok", "x", 150, "l2"), ("rejected", "x", None, "l3"), ("ok", "z", 60, "l4"), ("ok", "y", 250, "l5"), ("rejected", None, None, "l6")]
    records = spark.createDataFrame([("a", "w", 1, "f", i, *r) for i, r in enumerate(rows)],
                                    "dc string, datatype string, batch_id long, source_file string, row_id long, status string, op string, session_time long, line string")
    lines, kept = late.changed_lines(records, formats, 4)
    assert sorted(r["line"] for r in lines.collect()) == ["l1", "l3", "l4"] and sorted(r["line"] for r in kept.collect()) == ["l2", "l5", "l6"]
    assert late.changed_lines(records.where(F.col("op") == "y"), formats, 4) is None
