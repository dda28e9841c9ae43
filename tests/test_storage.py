"""Replacement without a gap, co-located buckets, data skipping, file sizes, statistics that steer plans."""

import glob
import threading

import pytest
from pyspark.sql import functions as F
from test_plans import scans_of

from tillroll.plans import orders as Q
from tillroll.sources import adapters as A
from tillroll.sources import catalog as IO
from tillroll.sources import layout as L

SF = "/root/testdata/sf0.001"


def location(spark, name):
    return next(r.data_type for r in IO.describe(spark, name).collect() if r.col_name == "Location")


def test_readers_never_miss_a_table_that_is_replaced(spark):
    name = "st_live"
    IO.materialize(spark.range(100), name)
    stop, seen, errors = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).agg(F.count("*"), F.min("id")).first()[0])
            except Exception as e:                            # any miss counts
                errors.append(repr(e)[:300])
    reader = threading.Thread(target=read)
    reader.start()
    for n in (200, 300, 400, 500):
        IO.materialize(spark.range(n), name)
    stop.set()
    reader.join()
    IO.drop_table(spark, name)
    assert not errors and seen <= {100, 200, 300, 400, 500} and len(seen) > 1


def test_a_reader_of_the_version_before_still_finds_its_files(spark):
    IO.materialize(spark.range(3), "st_versions")
    old = spark.table("st_versions")
    IO.materialize(spark.range(10, 14), "st_versions")
    assert old.count() == 3 and spark.table("st_versions").count() == 4
    place = location(spark, "st_versions").removeprefix("file:")
    for n in range(3):
        IO.materialize(spark.range(n), "st_versions")
    assert len(glob.glob(place.split("__v_")[0] + "*")) == 2   # this version and the one before
    IO.drop_table(spark, "st_versions")
    assert glob.glob(place.split("__v_")[0] + "*") == []


def test_other_columns_replace_the_table_too(spark):
    IO.materialize(spark.range(3), "st_columns")
    IO.materialize(spark.range(3).withColumn("x", F.lit(1)), "st_columns")
    assert spark.table("st_columns").columns == ["id", "x"]
    IO.drop_table(spark, "st_columns")


@pytest.fixture
def laid(spark):
    orders = L.store(A.orders(spark, SF), "st_orders", ["customer_id"], 8, ["created_at"], row_group_bytes=4096)
    names = A.customers(spark, SF).select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    yield orders, L.store_beside(names, "st_names", orders)
    for name in ("st_orders", "st_names"):
        L.drop(name, spark)


def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_the_colocated_join_has_no_exchange(spark, laid):
    without_broadcast(spark)
    try:
        cold, hot = L.colocated_join(*laid)
        plan = Q.spend_of(cold)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "HashAggregate" in plan
        got = Q.top_spenders([Q.spend_of(cold), Q.spend_of(hot)], 3).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == Q.top_customers_preagg(A.customers(spark, SF), A.orders(spark, SF), 3).collect()


def test_common_keys_lie_apart(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
                                  F.lit(1).alias("v"))
    facts = L.store(df, "st_facts", ["k"], 4)
    other = L.store_beside(spark.range(3000).select(F.col("id").alias("k"), F.lit("x").alias("name")), "st_other", facts)
    assert facts.hot.select("k").distinct().collect()[0].k == 7 and facts.hot.count() >= 1000
    assert other.hot.count() == 1 and facts.cold.where("k = 7").count() == 0
    assert facts.all().count() == 3000
    cold, hot = L.colocated_join(facts, other)
    assert cold.count() + hot.count() == 3000
    with pytest.raises(ValueError):
        L.colocated_join(facts, L.Layout(["id"], 4, facts.cold, facts.hot, facts.hot_keys))
    for name in ("st_facts", "st_other"):
        L.drop(name, spark)


def test_a_range_of_dates_skips_row_groups(spark):
    days = spark.range(60_000).select((F.col("id") % 50).alias("customer_id"), F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 600 as int))").alias("created_at"),
        F.md5(F.col("id").cast("string")).alias("rest")).withColumn("day", F.col("created_at").cast("date"))
    IO.write_layout(days, "st_days", ["customer_id"], 2, ["created_at"], row_group_bytes=64 * 1024)
    t = spark.table("st_days")
    month = t.where("day >= date'2024-05-01' and day < date'2024-06-01'").select("rest", "created_at")
    n = len(month.collect())
    (scan,) = scans_of(month)
    whole = t.select("rest")
    whole.collect()
    (all_rows,) = scans_of(whole)
    assert n == 3100 and all_rows["numOutputRows"] == 60_000 and n <= scan["numOutputRows"] < 20_000
    IO.drop_table(spark, "st_days")


def test_rebalanced_files_have_the_advised_size(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    try:
        df = spark.range(0, 40_000, 1, 64).withColumn("x", F.md5(F.col("id").cast("string")))
        IO.write_sized(df, "st_sized")
        place = location(spark, "st_sized").removeprefix("file:")
        files = glob.glob(place + "/*.parquet")
        assert 2 <= len(files) <= 24                          # 64 tasks made the rows
        # a value that holds most rows is split; 64 tasks with seven values each would write 448 files
        keyed = df.withColumn("k", F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id") % 7))
        IO.write_partitioned(keyed, "st_keyed", ["k"])
        place = location(spark, "st_keyed").removeprefix("file:")
        counts = {k: len(glob.glob(f"{place}/k={k}/*.parquet")) for k in range(7)}
        assert counts[0] > 1 and min(counts.values()) > 0 and sum(counts.values()) < 60
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        for name in ("st_sized", "st_keyed"):
            IO.drop_table(spark, name)


def test_statistics_steer_the_join_order(spark):
    """Three tables written in a bad order: with statistics the optimizer joins the two small ones first."""
    spark.range(20_000).select((F.col("id") % 1000).alias("a"), (F.col("id") % 500).alias("b")).write.saveAsTable("st_big")
    spark.range(1000).select(F.col("id").alias("a1"), (F.col("id") % 10).alias("g")).write.saveAsTable("st_mid")
    spark.range(10).select(F.col("id").alias("g1")).write.saveAsTable("st_few")
    conf = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        def order():
            df = spark.sql("SELECT * FROM st_big JOIN st_mid ON a = a1 JOIN st_few ON g = g1 WHERE g1 = 3")
            lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
            joins = [line for line in lines if "Join Inner" in line]
            return ["g1" in j for j in joins], df.count()
        before, n = order()
        for name in ("st_big", "st_mid", "st_few"):
            IO.compute_statistics(spark, name)
        after, m = order()
    finally:
        for k in conf:
            spark.conf.unset(k)
        for name in ("st_big", "st_mid", "st_few"):
            IO.drop_table(spark, name)
    assert n == m == 2000
    assert before == [True, False] and after == [False, True]     # the outer join comes first in the text


def test_preview_and_schema_rows(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (1, "a")], "id int, t string")
    assert [tuple(r) for r in IO.preview(df.repartition(3), 2).collect()] == [(1, "a"), (1, None)]
    assert [tuple(r) for r in IO.schema_rows(df).collect()] == [(0, "id", "int", True), (1, "t", "string", True)]


def test_padded_ids(spark):
    from tillroll.sources.generate import padded_id
    df = spark.createDataFrame([(7,), (1234,), (None,)], "n int").select(padded_id("T", F.col("n")).alias("t"))
    assert [r.t for r in df.collect()][:2] == ["T007", "T1234"]
