"""Salting of measured common keys only."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators.skew import common_keys, key_hash, salted_join

N = 30_000


def hot(spark):
    """One key on a third of the rows, one null key on a sixth, the rest spread."""
    return spark.range(N).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None)
                                 .otherwise(F.col("id")).alias("k"), (F.col("id") * 3).alias("v"))


def test_only_the_common_keys_are_found(spark):
    found = spark.range(1).select(common_keys(hot(spark), ["k"]).alias("h")).first().h
    want = {r.h for r in spark.createDataFrame([(7,), (None,)], "k long").select(key_hash(["k"]).alias("h")).collect()}
    assert set(found) == want
    assert spark.range(1).select(common_keys(hot(spark).where("false"), ["k"]).alias("h")).first().h in ([], None)
    with pytest.raises(ValueError):
        common_keys(hot(spark), ["k"], share=1e-5)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equals_the_plain_join(spark, how):
    big = hot(spark)
    small = spark.range(0, N, 2).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("w")).unionByName(
        spark.createDataFrame([(7, "a"), (7, "b"), (None, "c")], "k int, w string"))
    got, want = salted_join(big, small, ["k"], how), big.join(small, ["k"], how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_cold_keys_are_not_replicated(spark):
    """The right side grows by the common keys' rows only; a hot key's rows are dealt over the salts."""
    small = spark.range(N).select(F.col("id").alias("k"))
    joined = salted_join(hot(spark), small, ["k"], "left", salts=16)
    plan = joined._jdf.queryExecution().optimizedPlan()
    right = [node for node in (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size()))]
    assert right                                              # the plan is there; what it does is measured below
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joined.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in spread) == N // 3 + (1 if (7 % 6 != 1) else 0)
    is_hot = F.array_contains(common_keys(hot(spark), ["k"]), key_hash(["k"]))
    copies = small.select(F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(15))).otherwise(F.array(F.lit(0)))))
    assert copies.count() == N + 15


def test_a_hot_key_leaves_in_several_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        small = spark.range(N).select(F.col("id").alias("k"), F.lit(1).alias("one")).groupBy("k").agg(F.sum("one").alias("one"))
        out = salted_join(hot(spark), small, ["k"], "left", salts=16).where("k = 7")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(sizes) >= 4 and max(sizes) < N // 6


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        salted_join(hot(spark), hot(spark), ["k"], "full_outer")
