"""Arrival-driven runs keep dictionaries across micro-batches."""

import os

from cdrflow.sources import tables
from cdrflow.sources.tables import Warehouse
from cdrflow.streaming.arrival import run_available

import cdr_fixtures as fx


def test_arrival_runs_only_new_files(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    d = os.path.join(landing, "idc", "webcdr")
    os.makedirs(d)
    with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
        fh.write(fx.descriptor(fx.START_1, ";"))
    fx.write(os.path.join(d, "CDR_alphanet_20240304_080000_h1_0001"), fx.ALPHANET_1[:3])
    wh_root, ckpt = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "ckpt")
    run_available(spark, landing, wh_root, ckpt)
    wh = Warehouse(wh_root)
    assert tables.dim_user(spark, wh).count() == 3
    first_ids = {r["msisdn"]: r["user_id"] for r in tables.dim_user(spark, wh).collect()}

    # nothing new: a second run reads no file
    run_available(spark, landing, wh_root, ckpt)
    assert spark.read.parquet(wh.enriched).count() == 3

    fx.write(os.path.join(d, "CDR_alphanet_20240304_090000_h1_0002"), fx.ALPHANET_1[3:])
    run_available(spark, landing, wh_root, ckpt)
    dim = {r["msisdn"]: r["user_id"] for r in tables.dim_user(spark, wh).collect()}
    assert len(dim) == 4 and all(dim[k] == v for k, v in first_ids.items())
    assert dim[fx.DORA] == 4
    assert spark.read.parquet(wh.enriched).count() == len(fx.ALPHANET_1)


def test_long_running_stream_takes_new_files(spark, tmp_dir):
    from cdrflow.streaming.arrival import start
    landing = os.path.join(tmp_dir, "landing")
    d = os.path.join(landing, "idc", "webcdr")
    os.makedirs(d)
    with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
        fh.write(fx.descriptor(fx.START_1, ";"))
    fx.write(os.path.join(d, "CDR_alphanet_20240304_080000_h1_0001"), fx.ALPHANET_1[:3])
    wh_root = os.path.join(tmp_dir, "wh")
    q = start(spark, landing, wh_root, os.path.join(tmp_dir, "ckpt"),
              available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        fx.write(os.path.join(d, "CDR_alphanet_20240304_090000_h1_0002"), fx.ALPHANET_1[3:])
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    wh = Warehouse(wh_root)
    assert tables.dim_user(spark, wh).count() == 4
    assert spark.read.parquet(wh.enriched).count() == len(fx.ALPHANET_1)


def test_two_checkpoints_do_not_replace_each_other(spark, tmp_dir):
    roots = []
    for name, n in (("a", 3), ("b", 2)):
        landing = os.path.join(tmp_dir, name)
        d = os.path.join(landing, "idc", "webcdr")
        os.makedirs(d)
        with open(os.path.join(d, "data_format-x-alphanet-1.properties"), "w") as fh:
            fh.write(fx.descriptor(fx.START_1, ";"))
        fx.write(os.path.join(d, "CDR_alphanet_20240304_080000_h1_0001"), fx.ALPHANET_1[:n])
        roots.append(landing)
    wh = Warehouse(os.path.join(tmp_dir, "wh"))
    for i, landing in enumerate(roots):
        run_available(spark, landing, wh.root, os.path.join(tmp_dir, f"ckpt{i}"))
    assert tables.read_table(spark, wh.enriched).count() == 5
