"""Searching many versions gives what walking them gives."""

import random

from pyspark.sql import functions as F

from cdrflow.operators import standardize
from cdrflow.operators.asof import starts_until, versions_per_operator
from cdrflow.sources.descriptors import parse_descriptors

import cdr_fixtures as fx

COLUMNS = ["row_id", "session_time", "format_name", "reason", "msisdn", "urls"]


def formats(spark, n, seed):
    """``n`` versions of one operator: three delimiters, two ways to write the time, equal starts."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = fx.descriptor(f"2024-01-{r.randrange(1, 29):02d} {r.randrange(24):02d}:00:00", r.choice(";|#"))
        if r.random() < 0.4:
            text = text.replace('"session_time", "type": "int", "format": ""', '"session_time", "type": "String", "format": "yyyy-MM-dd HH:mm:ss"')
        rows.append(("idc", "webcdr", f"data_format-x-alphanet-{r.randrange(1000)}.properties", text, r.randrange(5)))
    return parse_descriptors(spark.createDataFrame(rows, "dc string, datatype string, file_name string, content string, registered_at long").dropDuplicates(["file_name", "registered_at"]))


def lines(spark, n, seed):
    r = random.Random(seed)
    start, rows = 1_703_900_000, []
    for i in range(n):
        t = start + r.randrange(35 * 86_400)
        time = t if r.random() < 0.6 else f"2024-01-{r.randrange(1, 31):02d} {r.randrange(24):02d}:30:00"
        rows.append(("idc", "webcdr", 1, r.choice(["alphanet"] * 8 + ["nobody", None]), "f", i, fx.record(fx.ANNA, time, pages="1", urls="x=http://a/b", sep=r.choice(";|#"))))
    rows.append(("idc", "webcdr", 1, "alphanet", "f", n, "no line"))
    return spark.createDataFrame(rows, "dc string, datatype string, batch_id long, op string, source_file string, row_id long, line string")


def rows_of(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def test_search_equals_walk(spark, monkeypatch):
    known, raw = formats(spark, 80, 3).cache(), lines(spark, 600, 4)
    walked = rows_of(standardize.parse_lines(raw, versions_per_operator(known)))
    assert rows_of(standardize.parse_by_formats(raw, known)) == walked
    assert sum("reason=None" in r for r in walked) > 200 and len(walked) == 601
    monkeypatch.setattr(standardize, "MANY", 0)
    few = formats(spark, 2, 5)
    assert rows_of(standardize.parse_by_formats(raw, few)) == rows_of(standardize.parse_lines(raw, versions_per_operator(few)))


def test_the_plan_does_not_grow_with_versions(spark, monkeypatch):
    monkeypatch.setattr(standardize, "MANY", 0)
    raw = lines(spark, 5, 6)
    sizes = set()
    for n in (2, 60):
        plan = standardize.parse_by_formats(raw, formats(spark, n, 7))._jdf.queryExecution().optimizedPlan().toString()
        sizes.add(plan.count("\n"))
        assert plan.count("aggregate(versions") == 1, plan
    assert len(sizes) == 1


def test_starts_until(spark):
    starts = [10, 20, 20, 35, 90]
    df = spark.createDataFrame([(t, starts[:n]) for t in range(0, 100, 5) for n in range(6)], "t long, s array<long>")
    for r in df.select("t", "s", starts_until(F.col("s"), F.col("t")).alias("n")).collect():
        assert r["n"] == sum(x <= r["t"] for x in r["s"])
