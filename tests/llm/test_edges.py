"""Each operator on nulls, odd texts, repeated rows, empty tables and clashing columns."""

import pytest

from cdrflow.llm import (bpe, decontaminate, line_dedup, lm, near_dup, quality, rules, secrets, stages, toxicity, urls)

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int, text string"
N = len(ODD)


def labels(spark, rows=()):
    return spark.createDataFrame([(*r, "clash") for r in rows], LABELS)


def items(spark, rows=()):
    return spark.createDataFrame([(*r, 0) for r in rows], "item_id long, text string, doc_id long")


OPERATORS = {
    "op1": lambda s, d: decontaminate.digest(decontaminate.contamination(d, items(s, [(1, "one"), (2, None), (3, "")]))),
    "op2": lambda s, d: line_dedup.report(d),
    "op3": lambda s, d: lm.scores(d),
    "op5": lambda s, d: rules.report(d),
    "op5 cascade": lambda s, d: rules.judged(d).select("doc_id", "failed_rule"),
    "op6": lambda s, d: quality.quality(d, quality.fit(d, labels(s, [(8, 1, 0), (None, 1, 1), (4, None, None)]))),
    "op7": lambda s, d: bpe.encoded(d, bpe.tokenizer_path()),
    "op8": lambda s, d: secrets.digest(secrets.secrets(d)),
    "op9": lambda s, d: near_dup.near_duplicates(d),
    "op10": lambda s, d: toxicity.toxicity(d, toxicity.fit(d, labels(s, [(8, 1, 0), (None, 1, 1), (4, None, None)]))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_are_all_returned(spark, make_docs, name):
    out = OPERATORS[name](spark, make_docs(ODD))
    rows = out.collect()
    assert len(rows) == N and len(set(out.columns)) == len(out.columns)
    key = lambda x: (x is None, x)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((r[0] for r in ODD), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, make_docs, name):
    assert OPERATORS[name](spark, make_docs([])).collect() == []


def test_urls_with_odd_rows_and_none(spark):
    schema = "page_id long, url string, html string, host long, verdict int"
    rows = [(1, None), (None, "x"), (2, ""), (3, "http://A.example.ORG/es/x?y#z"), (3, "http://A.example.ORG/es/x?y#z"), (4, "://"),
            (5, "https://b.com"), (6, "https://notorg/"), (7, "h://x.org?q"), (8, "http://" + "é" * 5000 + ".net/a")]
    got = urls.judged(spark.createDataFrame([(*r, None, None, None) for r in rows], schema)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[1]["host"], by[1]["path"], by[1]["rule"]) == ("", "", None)
    assert (by[3]["host"], by[3]["path"], by[3]["rule"], by[3]["verdict"]) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[7]["rule"] is None and by[7]["path"] == "" and by[6]["rule"] is None
    assert urls.judged(spark.createDataFrame([], schema)).collect() == []


def test_stages_keep_columns_and_clean_rows(spark, make_docs, tmp_dir):
    items(spark, [(1, " ".join(f"q{i}" for i in range(30)))]).write.parquet(f"{tmp_dir}/benchmark.parquet")
    labels(spark).write.parquet(f"{tmp_dir}/labels.parquet")
    docs = make_docs(ODD)
    for stage in (stages.not_toxic, stages.line_deduped, stages.near_dedup, stages.decontaminated):
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns
        ids = {r["doc_id"] for r in out.collect()}
        assert ids >= {None, 1, 2, 3, 4, 5, 6, 7, 8, 10}
        assert stage(spark, make_docs([]), tmp_dir).collect() == []
    out = stages.tokenised(spark, docs, tmp_dir)
    assert out.count() == N and out.columns[: len(docs.columns)] == docs.columns
