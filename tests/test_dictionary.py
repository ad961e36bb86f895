"""Dictionaries: commits, races, takeover, compact form, layered lookups."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from cdrflow.operators import enrich, joins, lookup
from cdrflow.schema import USER_KEY
from cdrflow.sources import dictionary, tables
from cdrflow.sources.batches import Batches
from cdrflow.sources.commits import CommitLog
from cdrflow.sources.tables import Warehouse

KEYS = "dc string, op string, msisdn string, imsi string, imei string"


def keys(spark, names, dc="a"):
    return spark.createDataFrame([(dc, "op", n, "", "") for n in names], KEYS)


def ids(held):
    return {(r["dc"], r["msisdn"]): r["user_id"] for r in held.rows().collect()}


def test_a_number_is_taken_once(spark, tmp_dir):
    log = CommitLog(spark, f"{tmp_dir}/log")
    assert log.last() == 0 and log.numbers() == []
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if log.put(1, {"by": i}) else None) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and log.read(1) == {"by": won[0]} and not log.put(1, {"by": 9})
    for n in (2, 3, 999, 1000, 1001, 2500):
        assert log.put(n, {})
    assert log.last() == 2500 and log.numbers(999) == [1000, 1001, 2500] and log.numbers()[:3] == [1, 2, 3]


def test_writers_that_saw_the_same_state(spark, tmp_dir):
    held = dictionary.users(spark, Warehouse(tmp_dir))
    seen = held.snapshot()
    assert held.extend(keys(spark, ["b", "a"]), 1, at=seen) == 2
    assert held.extend(keys(spark, ["c", "b", "d"]), 2, at=seen) == 2
    assert held.extend(keys(spark, ["d", "a"]), 3, at=seen) == 0
    assert held.extend(keys(spark, ["a"], dc="z"), 4, at=seen) == 1
    assert ids(held) == {("a", "a"): 1, ("a", "b"): 2, ("a", "c"): 3, ("a", "d"): 4, ("z", "a"): 1}
    assert {r["commit"] for r in spark.read.parquet(f"{tmp_dir}/dim_user").collect()} == {"1", "2", "3"}


def test_a_commit_whose_writer_died_is_put_in_place(spark, tmp_dir, monkeypatch):
    held = dictionary.users(spark, Warehouse(tmp_dir))
    with monkeypatch.context() as m:
        m.setattr(dictionary.Dictionary, "_published", lambda self, commit: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            held.extend(keys(spark, ["a"]), 1)
    assert not os.path.exists(f"{tmp_dir}/dim_user")
    assert held.extend(keys(spark, ["a", "b"]), 2) == 1
    assert ids(held) == {("a", "a"): 1, ("a", "b"): 2}
    # one that dies before its claim leaves rows that nobody sees
    keys(spark, ["x"]).write.parquet(f"{tmp_dir}/dim_user_log/staged-lost")
    assert len(ids(held)) == 2


def test_an_older_dictionary_is_adopted(spark, tmp_dir):
    old = keys(spark, ["a", "b"]).withColumns({"user_id": F.when(F.col("msisdn") == "a", 7).otherwise(3).cast("bigint"), "batch_id": F.lit(1).cast("bigint")})
    old.write.partitionBy("dc").parquet(f"{tmp_dir}/dim_user")
    held = dictionary.users(spark, Warehouse(tmp_dir))
    assert held.extend(keys(spark, ["b", "c"]), 2) == 1
    assert ids(held) == {("a", "a"): 7, ("a", "b"): 3, ("a", "c"): 8}


def test_compact_and_recent_rows(spark, tmp_dir):
    held = dictionary.users(spark, Warehouse(tmp_dir))
    held.extend(keys(spark, [f"n{i}" for i in range(50)]), 1)
    held.compact(buckets=6)
    held.extend(keys(spark, ["n3", "late"]), 2)
    at = held.snapshot()
    assert at.compact["buckets"] == 6 and len(at.commits) == 1 and at.rows_total == 51
    layers = held.layers()
    assert layers.base.count() == 50 and layers.recent.count() == 1 and held.rows().count() == 51
    assert held.extend(keys(spark, ["late", "n7"]), 3) == 0
    assert ids(held)[("a", "late")] == 51
    held.compact()
    assert held.snapshot().commits == [] and held.rows().count() == 51


def _lookup(spark, held, monkeypatch, facts, bound):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", bound)
    return lookup.with_value(facts, held.layers(), USER_KEY, "user_id")


def test_layered_lookup_is_the_plain_one(spark, tmp_dir, monkeypatch):
    """Hot keys, keys that only later commits have, unknown and null keys, repeated rows."""
    held = dictionary.users(spark, Warehouse(tmp_dir))
    held.extend(keys(spark, [f"n{i}" for i in range(40)]), 1)
    held.compact()
    held.extend(keys(spark, ["late", "later"]), 2)
    names = ["n1"] * 6000 + [f"n{i % 45}" for i in range(3000)] + ["late"] * 30 + ["later", "nobody"] + [None] * 900
    facts = spark.createDataFrame([("a", "op", n, "", "", i % 50) for i, n in enumerate(names)], KEYS + ", x long")
    facts.write.parquet(f"{tmp_dir}/facts")
    facts = spark.read.parquet(f"{tmp_dir}/facts")
    small = sorted(map(str, _lookup(spark, held, monkeypatch, facts, 1000).select("msisdn", "x", "user_id").collect()))
    large = _lookup(spark, held, monkeypatch, facts, 1)  # base joined by bucket; recent rows are compacted first
    assert sorted(map(str, large.select("msisdn", "x", "user_id").collect())) == small
    assert len(small) == len(names) and sum("user_id=None" in r for r in small) == 900 + sum(n in ("nobody",) or (n or "")[1:] in map(str, range(40, 45)) for n in names)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)  # recent rows are broadcast beside the base
    new = lookup.unknown(keys(spark, ["n1", "late", "fresh"]), held.layers(), USER_KEY)
    assert [r["msisdn"] for r in new.collect()] == ["fresh"]


def _above(plan, leaf):
    """Operators of an executed plan from the scan ``leaf`` up to the first join."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            depth = d
            found.append(line.strip(" :+-"))
            if "Join" in line:
                return found
    raise AssertionError(plan)


def test_a_compact_dictionary_is_not_shuffled(spark, tmp_dir, monkeypatch):
    held = dictionary.users(spark, Warehouse(tmp_dir))
    held.extend(keys(spark, [f"n{i}" for i in range(40)]), 1)
    held.compact()
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = keys(spark, ["n1", "n2", "x"]).withColumn("row_id", F.monotonically_increasing_id())
        for df in (lookup.with_value(facts, held.layers(), USER_KEY, "user_id"),
                   lookup.unknown(facts.select(*USER_KEY).distinct(), held.layers(), USER_KEY)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            base = [line for line in plan.split("\n") if "cdr_dim_" in line and "Bucketed: true" in line]
            assert base, plan
            assert not any("Exchange" in op for op in _above(plan, base[-1])), plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


URLS = "dc string, batch_id long, row_id long, urls array<string>"


def test_page_lists_on_both_paths(spark, tmp_dir, monkeypatch):
    rows = [("a", 1, 1, ["x", "y", "x"]), ("a", 1, 2, []), ("a", 1, 3, None), ("b", 1, 4, ["x"]), ("a", 1, 5, ["nowhere", "y"]),
            ("a", 1, 6, [f"p{i % 3}" for i in range(20)])]
    std = spark.createDataFrame(rows, URLS)
    dim = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 9)] + [("a", f"p{i}", 20 + i) for i in range(3)], "dc string, url string, page_id long")
    want = {1: [1, 2, 1], 2: [], 3: [], 4: [9], 5: [None, 2], 6: [20 + i % 3 for i in range(20)]}
    got = {r["row_id"]: r["page_ids"] for r in enrich.with_page_ids(std, dim).collect()}
    assert got == want
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    assert {r["row_id"]: r["page_ids"] for r in enrich.with_page_ids(std, dim).collect()} == want
    assert enrich.with_page_ids(std.where("false"), dim).collect() == []


def test_short_page_lists_move_no_row(spark):
    std = spark.createDataFrame([("a", 1, 1, ["x", "y"])], URLS)
    dim = spark.createDataFrame([("a", "x", 1)], "dc string, url string, page_id long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = enrich.with_page_ids(std, dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.replace("BroadcastExchange", "").replace("ReusedExchange", "").count("Exchange") == 0, plan
    assert plan.count("BroadcastHashJoin") == 2


def test_whole_batches(spark, tmp_dir):
    wh = Warehouse(tmp_dir)
    b = Batches(spark, wh)
    rows = spark.createDataFrame([(i,) for i in range(1, 8)], "batch_id long")
    rows.withColumn("x", F.lit(1)).write.partitionBy("batch_id").parquet(wh.enriched)
    assert b.read(wh.enriched).count() == 0 and b.read(wh.usage) is None
    for n in (1, 2, 3, 5, 7):
        b.open(n)
        b.close(n)
    assert b._state()[1]["done"] == [[1, 3], [5, 5], [7, 7]]
    b.open(2)
    b.open(6)
    assert sorted(r["batch_id"] for r in b.read(wh.enriched).collect()) == [1, 3, 5, 7] and b.unfinished() == [2, 6]
    b.close(2)
    assert sorted(r["batch_id"] for r in b.read(wh.enriched).collect()) == [1, 2, 3, 5, 7]


def test_a_table_that_cannot_be_read_is_not_an_empty_one(spark, tmp_dir):
    assert tables.read_or_empty(spark, f"{tmp_dir}/none", "a long").count() == 0
    os.makedirs(f"{tmp_dir}/broken")
    with open(f"{tmp_dir}/broken/part-0.parquet", "w") as fh:
        fh.write("no parquet")
    with pytest.raises(Exception):
        tables.read_or_empty(spark, f"{tmp_dir}/broken", "a long").collect()
