"""A02, W01, W02 (dense ids) and the lookup-join strategies."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cdrflow.operators import joins
from cdrflow.operators.ids import assign_ids, highest_ids


def test_ids_continue_each_dc_in_key_order(spark):
    keys = spark.createDataFrame([("a", "x"), ("a", "b"), ("b", "z"), ("c", "q")], "dc string, k string")
    start = spark.createDataFrame([("a", 10), ("b", 0)], "dc string, _start bigint")
    got = {(r["dc"], r["k"]): r["id"] for r in assign_ids(keys, ["dc", "k"], "id", start).collect()}
    assert got == {("a", "b"): 11, ("a", "x"): 12, ("b", "z"): 1, ("c", "q"): 1}


def test_highest_ids_of_empty_dim(spark):
    empty = spark.createDataFrame([], "dc string, user_id bigint")
    assert highest_ids(empty, "user_id").count() == 0


def _facts(spark):
    # key 0 holds a third of all rows
    return spark.range(0, 30000, 1, 6).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("key"))


def test_shuffle_path_with_hot_key_equals_broadcast_path(spark):
    facts = _facts(spark)
    dim = spark.range(0, 500).select(F.col("id").alias("key"), (F.col("id") * 10).alias("val"))
    hot = joins.hot_keys(facts, ["key"], fraction=0.2)
    assert [r["key"] for r in hot.collect()][0] == 0
    a = joins.lookup_join(facts, dim, ["key"], "left")
    b = joins.lookup_join(facts, dim, ["key"], "left", broadcast_max_rows=0)
    assert b.count() == 30000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_anti_join_paths(spark):
    """Both sides large, the new keys small, the dictionary small."""
    facts = _facts(spark).select("key").distinct()
    dim = spark.range(0, 2500).select(F.when(F.col("id") < 500, F.col("id")).otherwise(F.col("id") + 5000).alias("key"))
    for bound in (0, 1500, 10_000):
        got = joins.anti_join(facts, dim, ["key"], broadcast_max_rows=bound)
        assert sorted(r["key"] for r in got.collect()) == list(range(500, 997))


def test_shuffle_path_reads_the_facts_once_for_its_join(spark, tmp_dir):
    _facts(spark).write.parquet(tmp_dir + "/facts")
    facts = spark.read.parquet(tmp_dir + "/facts")
    dim = spark.range(0, 500).select(F.col("id").alias("key"), (F.col("id") * 10).alias("val"))
    plan = joins.lookup_join(facts, dim, ["key"], broadcast_max_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "Union" not in plan


def test_ids_across_partition_boundaries_match_row_number(spark):
    keys = spark.range(0, 6000, 1, 5).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("dc"),
        F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % 6000).cast("string"), 5, "0")).alias("k"))
    start = spark.createDataFrame([("a", 100), ("b", 0)], "dc string, _start bigint")
    got = assign_ids(keys, ["dc", "k"], "id", start, partitions=7)
    want = (keys.join(start, "dc", "left")
            .select("dc", "k", (F.coalesce("_start", F.lit(0))
                                + F.row_number().over(Window.partitionBy("dc").orderBy("k"))).alias("id")))
    assert got.count() == 6000
    assert got.select("dc", "k", "id").exceptAll(want).count() == 0


def test_null_keys_bypass_the_shuffle_path(spark):
    facts = spark.range(0, 3000, 1, 4).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("key"))
    dim = spark.range(0, 40).select(F.col("id").alias("key"), (F.col("id") * 10).alias("val"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = facts.join(F.broadcast(dim), ["key"], how)
        got = joins.lookup_join(facts, dim, ["key"], how, broadcast_max_rows=0)
        assert got.count() == want.count(), how
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, how
