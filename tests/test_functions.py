"""F01-F16 and P05-P07 on tiny frames."""

from pyspark.sql import functions as F

from cdrflow.functions import (bucket_label, epoch_from_text, extract_urls, field_at,
                               operator_from_name, parse_int, parse_long, quote_regex, split_line)
from cdrflow.schema import DATA_FILE_PATTERN, FORMAT_FILE_PATTERN


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_split_keeps_trailing_empty_fields(spark):
    assert one(spark, F.size(split_line(F.lit("1;a;;"), ";"))) == 4


def test_split_by_literal_metacharacter(spark):
    parts = split_line(F.lit("a|b.c|"), quote_regex(F.lit("|")))
    assert one(spark, parts) == ["a", "b.c", ""]


def test_field_beyond_the_line_is_null(spark):
    assert one(spark, field_at(split_line(F.lit("a;b"), ";"), 5)) is None


def test_parse_int_is_strict(spark):
    vals = ["5", "+5", "-7", " 5", "1.5", "", "4000000000", "5L", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r["i"] for r in df.select(parse_int(F.col("v")).alias("i")).collect()]
    assert got == [5, 5, -7, None, None, None, None, None, None]
    got_l = [r["i"] for r in df.select(parse_long(F.col("v")).alias("i")).collect()]
    assert got_l[6] == 4000000000


def test_urls_stop_at_comma_line_end_and_question_mark(spark):
    text = "#702*#=file:/a/b.xml#x,1=https://h.com/p?q=1,2=http://h.com/z\r"
    assert one(spark, extract_urls(F.lit(text))) == ["file:/a/b.xml#x", "https://h.com/p", "http://h.com/z"]
    assert one(spark, extract_urls(F.lit(None).cast("string"))) == []
    assert one(spark, extract_urls(F.lit(""))) == []


def test_operator_from_names(spark):
    assert one(spark, operator_from_name(F.lit("CDR_alphanet_20120702_024801_localhost_0453"),
                                         DATA_FILE_PATTERN)) == "alphanet"
    assert one(spark, operator_from_name(F.lit("data_format-subs-5-gammatel_eu-20120921.properties"),
                                         FORMAT_FILE_PATTERN)) == "gammatel_eu"
    assert one(spark, operator_from_name(F.lit("CDR_bad_name"), DATA_FILE_PATTERN)) is None


def test_epoch_from_text_uses_explicit_zone(spark):
    assert one(spark, epoch_from_text(F.lit("2012-08-16 00:00:00"), "yyyy-MM-dd HH:mm:ss")) == 1345075200
    assert one(spark, epoch_from_text(F.lit("2012-08-16 02:00:00"), "yyyy-MM-dd HH:mm:ss",
                                      "Europe/Paris")) == 1345075200
    assert one(spark, epoch_from_text(F.lit("2012-08-16 02:00:00 +0200"), "yyyy-MM-dd HH:mm:ss Z",
                                      "Asia/Tokyo")) == 1345075200
    assert one(spark, epoch_from_text(F.lit("2012-08-16T00:00:00"), "yyyy-MM-dd'T'HH:mm:ss")) == 1345075200
    assert one(spark, epoch_from_text(F.lit("#702"), "yyyy-MM-dd HH:mm:ss")) is None
    assert one(spark, epoch_from_text(F.lit("2012-08-16"), "")) is None


def test_bucket_label_is_utc(spark):
    assert one(spark, bucket_label(F.lit(1344939827))) == "2012-08-14 10"


def test_a_text_without_the_marks_of_a_pattern_is_not_tried(spark):
    """What a pattern's marks leave out is what the parser would refuse."""
    from pyspark.sql import functions as F
    from cdrflow.functions.time import epoch_from_text, time_rule
    patterns = {"yyyy-MM-dd HH:mm:ss": ["-", " ", ":"], "yyyyMMdd": [], "yyyy-MM-dd'T'HH:mm": ["-", ":"], "yyyy[-MM]": [], "yyyy/MM/dd X": ["/", " "]}
    texts = ["2024-01-02 03:04:05", "1704164645", "-1704164645", "20240102", "2024-01-02T03:04", "2024", "2024/01/02 +01", "2024/01/02", "", "x", None]
    for pattern, marks in patterns.items():
        assert spark.range(1).select(time_rule(F.lit(pattern), F.lit("UTC"))["marks"]).first()[0] == marks
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        zoned = pattern.endswith("X")
        plain = F.unix_seconds(F.try_to_timestamp(F.col("t") if zoned else F.concat("t", F.lit(" UTC")), F.lit(pattern if zoned else pattern + " VV")))
        got = df.select(epoch_from_text(F.col("t"), pattern).alias("a"), F.when(F.trim("t") != "", plain).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]


def test_a_path_is_taken_apart_once_a_line(spark):
    from cdrflow.sources.landing import tag_lines
    raw = spark.createDataFrame([("a;b\r", "file:/l/dc0/webcdr/CDR_x_y_20240101_000000_h"), ("", "file:/l/dc0/webcdr/CDR_x_20240101_000000_h"),
                                 ("c", "file:/l/dc0/f"), ("d", "file:///l/dc0/a/b/CDR__20240101_000000"), ("e", "/other/f")], "line string, source_file string")
    tagged = tag_lines(raw, 1, "/l")
    got = {r["line"]: (r["dc"], r["datatype"], r["op"]) for r in tagged.collect()}
    assert got == {"a;b": ("dc0", "webcdr", "x_y"), "c": ("dc0", "_unplaced", None), "d": ("dc0", "_unplaced", None), "e": ("_unplaced", "_unplaced", None)}
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("regexp_extract(") == 1
