"""The driver contract."""

import __spark_entry__ as se


def test_every_query_has_an_oracle_or_is_listed():
    assert set(se.oracle_sql()) <= set(se.queries())
    assert len(se.queries()) >= 25


def test_entry_runs(spark):
    df = se.entry(spark)
    assert set(df.columns) == {"dc", "url", "hits"}
    assert df.count() > 0
