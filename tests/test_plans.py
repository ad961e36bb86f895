"""Plans: the version walk and the page extraction stand once in each."""

import pytest

from cdrflow.plans.reports import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["page_hits", "standard_rows", "bucket_counts", "format_rejects"])
def test_one_version_walk(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(reverse(versions") == 1, plan
    assert plan.count("regexp_extract_all(") <= 1, plan
