"""Descriptor parsing and flattening."""

from pyspark.sql import functions as F

from cdrflow.sources.descriptors import format_fields, parse_descriptors, parse_properties
from cdrflow.schema import URL_PATTERN

from cdr_fixtures import START_1, descriptor


def frame(spark, name, content, dc="idc"):
    return spark.createDataFrame([(dc, "webcdr", name, content, 1000)],
                                 "dc string, datatype string, file_name string, content string, registered_at bigint")


def test_properties_last_value_wins_and_comments(spark):
    text = "# comment\n! other\na=1\nb = two words\r\na=3\nc:x\n\n"
    m = spark.range(1).select(parse_properties(F.lit(text)).alias("m")).first()["m"]
    assert m == {"a": "3", "b": "two words", "c": "x"}


def test_descriptor_is_flattened_with_positions(spark):
    p = parse_descriptors(frame(spark, "data_format-x-alphanet-2012.properties",
                                descriptor(START_1, ";"))).first()
    assert p["problem"] is None
    assert p["op"] == "alphanet"
    assert p["start_time"] == 981_173_106
    assert p["delimiter"] == ";"
    assert p["layout"]["msisdn"]["pos"] == 0
    assert p["layout"]["session_time"]["type"] == "INT"
    assert p["layout"]["action_url"]["pos"] == 12
    assert p["layout"]["action_url"]["format"] == URL_PATTERN
    assert p["field_names"][-1] == "extra"


def test_format_fields_rows(spark):
    ff = format_fields(parse_descriptors(frame(spark, "data_format-x-alphanet-2012.properties",
                                               descriptor(START_1, "|"))))
    rows = {r["field"]: r for r in ff.collect()}
    assert len(rows) == 14 and rows["extra"]["pos"] == 13
    assert rows["action_url"]["format"] == URL_PATTERN


def test_bad_descriptors_are_flagged(spark):
    bad_name = parse_descriptors(frame(spark, "format.properties", descriptor(START_1, ";")))
    assert bad_name.first()["problem"] == "bad_descriptor_name"
    no_start = parse_descriptors(frame(spark, "data_format-x-a-1.properties", "delimiter=;\nfields={}"))
    assert no_start.first()["problem"] == "no_start_time"
    timed = descriptor(START_1, ";").replace('"session_time", "type": "int", "format": ""', '"session_time", "type": "String", "format": "%s"')
    for pattern, problem in (("yyyy-MM-dd HH:mm:ss nnnn", "bad_pattern"), ("EEE yyyy", "bad_pattern"), ("u-MM-dd", "bad_pattern"),
                             ("HHH:mm", "bad_pattern"), ("yyyy[-MM]", "bad_pattern"), ("yyyyMMdd'T'HHmmss.SSS", None), ("dd/MM/yyyy hh:mm a", None)):
        got = parse_descriptors(frame(spark, "data_format-x-a-1.properties", timed % pattern)).first()
        assert got["problem"] == problem, pattern
    # formats of other fields aren't patterns
    other = descriptor(START_1, ";").replace('"action_url", "type": "String", "format": ""', '"action_url", "type": "String", "format": "(file:.+)"')
    assert parse_descriptors(frame(spark, "data_format-x-a-1.properties", other)).first()["problem"] is None


def test_accepted_patterns_never_throw(spark):
    """Every accepted run of a letter can be parsed with, whatever the text."""
    from cdrflow.functions.time import VALID_PATTERN, epoch_from_text
    tried = [c * n for c in "yMLdDHhkKmsSaVzOXxZEuQqwWnNAeFcGB" for n in range(1, 11)] + ["yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "", "-"]
    df = spark.createDataFrame([(p,) for p in tried], "p string").where(F.col("p").rlike(VALID_PATTERN))
    accepted = [r["p"] for r in df.collect()]
    assert {"yyyy", "VV", "OOOO", "SSSSSSSSS", "yyyyMMddHHmmss"} <= set(accepted) and not {"V", "OO", "HHH", "E", "u", "dd" * 2} & set(accepted)
    texts = ["2024-03-04", "20240304080000", "x", "Mar", "12", ""]
    for p in accepted:
        spark.createDataFrame([(t,) for t in texts], "t string").select(epoch_from_text(F.col("t"), p)).collect()


def test_unicode_escapes(spark):
    m = spark.range(1).select(parse_properties(F.lit("a=caf\\u00e9 \\u4e2d\nb=x")).alias("m")).first()["m"]
    assert m == {"a": "caf\u00e9 \u4e2d", "b": "x"}


def test_properties_line_continuation(spark):
    text = 'fields={"fields": [{"name": "msisdn", \\\n    "type": "String", "format": ""}]}\npath=c:\\\\\\\\\nnext=1\n'
    m = spark.range(1).select(parse_properties(F.lit(text)).alias("m")).first()["m"]
    assert m["fields"] == '{"fields": [{"name": "msisdn", "type": "String", "format": ""}]}'
    assert m["path"] == "c:\\\\" and m["next"] == "1"


def test_properties_are_read_in_one_pass(spark):
    """What an escape gives is never an escape again; comments don't continue; a lone \\r ends a line."""
    cases = {r"a=\\\u0041": "\\A", r"a=\u005Cn": "\\n", r"a=\\\t": "\\\t", r"a=\\t": "\\t", r"a=x\\": "x\\", r"a=x\q\=\:\ y": "xq=: y",
             "# note \\\na=1": "1", "! note\\\ra=1": "1", "a=1\\\r\n   2\\\n\t3": "123", "a=1\\\\\nb=2": "1\\", "a 1": "1", "a\t:\t1": "1", "\r\n \t\na=1": "1",
             r"\u0061=1": "1", r"a=\u4e2d\u6587": "\u4e2d\u6587", r"a=\u00": "u00", "a": "", "a=": "", "a==x": "=x"}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["a"] for r in df.select("i", parse_properties(F.col("t"))["a"].alias("a")).collect()}
    assert got == dict(enumerate(cases.values()))
    long = "fields=" + "x\\=y" * 20_000  # as deep as a regex may recurse on a stream's thread
    assert spark.createDataFrame([(long,)], "t string").select(F.length(parse_properties(F.col("t"))["fields"])).first()[0] == 60_000


def test_a_filter_on_the_problem_parses_no_descriptor_again(spark):
    """Each step is in the plan once, whatever is asked of its result."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        good = parse_descriptors(frame(spark, "data_format-x-a-1.properties", descriptor(START_1, ";"))).where(F.col("problem").isNull())
        plan = good._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    assert plan.count("from_json(") == 1
    assert good.count() == 1
