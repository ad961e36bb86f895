"""Format choice and quarantine."""

from cdrflow.operators.asof import versions_per_operator
from cdrflow.operators.standardize import parse_lines
from cdrflow.sources.descriptors import parse_descriptors

from cdr_fixtures import descriptor

SCHEMA = "dc string, datatype string, file_name string, content string, registered_at bigint"


def catalog(spark, rows):
    return versions_per_operator(parse_descriptors(spark.createDataFrame(rows, SCHEMA)))


def lines(spark, rows):
    return spark.createDataFrame(
        [("idc", "webcdr", 1, op, "f", i, line) for i, (op, line) in enumerate(rows)],
        "dc string, datatype string, batch_id bigint, op string, source_file string, row_id bigint, line string")


def test_latest_version_not_after_the_session_time(spark):
    cat = catalog(spark, [
        ("idc", "webcdr", "data_format-x-op-1.properties", descriptor("2012-01-01 00:00:00", ";"), 1),
        ("idc", "webcdr", "data_format-x-op-2.properties", descriptor("2012-08-16 00:00:00", ";"), 1),
    ])
    base = "+33;;;;en;{t};#1;U2;0;1;;;;"
    df = lines(spark, [("op", base.format(t=1345075199)), ("op", base.format(t=1345075200)),
                       ("op", base.format(t=1300000000)), ("nop", base.format(t=1345075200))])
    got = {r["row_id"]: (r["format_name"], r["reason"]) for r in parse_lines(df, cat).collect()}
    assert got[0] == ("data_format-x-op-1.properties", None)
    assert got[1] == ("data_format-x-op-2.properties", None)
    assert got[2] == (None, "no_valid_format")
    assert got[3] == (None, "unknown_operator")


def test_time_is_read_through_each_candidate_layout(spark):
    # v2 is newer but '|'-delimited: a ';' line after its start still takes v1.
    cat = catalog(spark, [
        ("idc", "webcdr", "data_format-x-op-1.properties", descriptor("1970-01-01 00:00:00", ";"), 1),
        ("idc", "webcdr", "data_format-x-op-2.properties", descriptor("2012-08-16 00:00:00", "|"), 1),
    ])
    df = lines(spark, [("op", "+33;;;;en;1345200000;#1;U2;0;1;;;;"),
                       ("op", "+33|||||1345200000|#1|U2|0|1||||")])
    got = {r["row_id"]: r for r in parse_lines(df, cat).collect()}
    assert got[0]["format_name"].endswith("-1.properties")
    assert got[1]["format_name"].endswith("-2.properties")
    assert got[1]["msisdn"] == "+33" and got[1]["session_time"] == 1345200000


def test_tie_on_start_goes_to_newest_registration(spark):
    cat = catalog(spark, [
        ("idc", "webcdr", "data_format-x-op-1.properties", descriptor("2012-01-01 00:00:00", ";"), 5),
        ("idc", "webcdr", "data_format-x-op-0.properties", descriptor("2012-01-01 00:00:00", ";"), 9),
    ])
    df = lines(spark, [("op", "+33;;;;en;1345200000;#1;U2;0;1;;;;")])
    assert parse_lines(df, cat).first()["format_name"] == "data_format-x-op-0.properties"


def test_many_versions(spark):
    rows = [("idc", "webcdr", f"data_format-x-op-{i:02d}.properties",
             descriptor(f"2012-01-{i:02d} 00:00:00", ";"), 1) for i in range(1, 31)]
    cat = catalog(spark, rows)
    df = lines(spark, [("op", "+33;;;;en;1326067200;#1;U2;0;1;;;;")])  # 2012-01-09
    assert parse_lines(df, cat).first()["format_name"] == "data_format-x-op-09.properties"


def test_failfast_mode_raises_on_a_bad_line(spark):
    import pytest
    cat = catalog(spark, [
        ("idc", "webcdr", "data_format-x-op-1.properties", descriptor("2012-01-01 00:00:00", ";"), 1)])
    df = lines(spark, [("op", "+33;;;;en;1345075199;#1;U2;0;1;;;;"), ("nop", "+33;;;;en;1;#1;U2;0;1;;;;")])
    with pytest.raises(Exception, match="unknown_operator"):
        parse_lines(df, cat, mode="failfast").collect()
    assert parse_lines(df.where("op = 'op'"), cat, mode="failfast").count() == 1
