"""Skew: one subscriber and one page hold most rows; the shuffle path with
hot-key split must give the same enrichment as the broadcast path."""

from pyspark.sql import functions as F

from cdrflow.operators import dims, enrich, joins


def _std(spark, n=20000):
    hot = F.col("id") % 3 != 0  # two thirds of rows belong to one subscriber / page
    return spark.range(0, n, 1, 8).select(
        F.lit("dc0").alias("dc"), F.lit("webcdr").alias("datatype"), F.lit(1).cast("bigint").alias("batch_id"),
        F.lit("alphanet").alias("op"),
        F.when(hot, F.lit("+33600000000")).otherwise(F.concat(F.lit("+336"), (F.col("id") % 500).cast("string"))).alias("msisdn"),
        F.lit("").alias("imsi"), F.lit("").alias("imei"), F.lit("").alias("subscription"),
        F.lit("en").alias("language"), (F.lit(1704067200) + F.col("id")).alias("session_time"),
        F.lit("#702").alias("service_code"), F.lit("U2").alias("bearer"),
        F.lit("2").alias("page_sent"), F.lit("10").alias("duration"), F.lit("").alias("vlr_number"),
        F.lit("").alias("session_end"),
        F.array(F.when(hot, F.lit("http://hot.example/")).otherwise(
            F.concat(F.lit("http://p.example/"), (F.col("id") % 700).cast("string"))),
            F.concat(F.lit("http://q.example/"), (F.col("id") % 50).cast("string"))).alias("urls"),
        F.lit(None).cast("string").alias("extra"), F.col("id").alias("row_id"))


def test_enrich_shuffle_path_equals_broadcast_path(spark, monkeypatch):
    std = _std(spark).checkpoint(eager=True)
    empty_u = spark.createDataFrame([], "dc string, user_id bigint, op string, msisdn string, imsi string, imei string, batch_id bigint")
    empty_p = spark.createDataFrame([], "dc string, page_id bigint, url string, batch_id bigint")
    dim_u = dims.new_users(std, empty_u, 1).checkpoint(eager=True)
    dim_p = dims.new_pages(std, empty_p, 1).checkpoint(eager=True)
    assert dim_u.count() == 501 and dim_p.count() == 1 + 700 + 50
    fast = enrich.enrich(std, dim_u, dim_p).checkpoint(eager=True)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    slow = enrich.enrich(std, dim_u, dim_p)
    plan = slow._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert slow.count() == 20000
    assert slow.exceptAll(fast).count() == 0
    hot_id = dim_u.where("msisdn = '+33600000000'").first()["user_id"]
    assert slow.where(F.col("user_id") == hot_id).count() == 20000 - 20000 // 3 - (1 if 20000 % 3 else 0)


def test_hot_share_follows_the_partitions(spark, monkeypatch):
    """Many partitions: a key of half a partition's mean share is hot; never more than HOT_MOST keys."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, share in (("4", joins.HOT_MIN_SHARE), ("5000", joins.HOT_PART / 5000), ("10000000", 1 / joins.HOT_MOST)):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert joins.hot_share(spark) == share
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # A key with 1 row in 2,000 of all: below a thousandth.
    facts = spark.range(400_000).select(F.when(F.col("id") % 2_000 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"))
    assert joins.hot_keys(facts, ["key"], fraction=0.5).count() == 0
    monkeypatch.setattr(joins, "HOT_MIN_SHARE", joins.HOT_PART / 5000)
    assert [r["key"] for r in joins.hot_keys(facts, ["key"], fraction=0.5).collect()] == [-1]
