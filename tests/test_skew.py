"""A hot key holding a third of the rows: results stay whole and exact, and AQE
splits the skewed sort-merge partitions (broadcast disabled, tiny thresholds)."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quality as V
from tillroll.operators.relational import first_per_group
from tillroll.plans import orders as Q

N = 30000


@pytest.fixture
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(spark):
    """id, key: one key (7) holds a third of the rows."""
    return spark.range(N).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7))
                                 .otherwise(F.col("id") % 1000).alias("key"))


def test_duplicate_keys_with_a_hot_key(skew_conf):
    spark = skew_conf
    df = _hot(spark)
    out = V.duplicate_keys(df, ["key"], "id")
    pdf = df.toPandas()
    counts = pdf.groupby("key")["id"].transform("count")
    want = pdf[counts > 1]
    got = out.toPandas()
    assert len(got) == len(want) == N                     # every row's key repeats; nothing dropped
    assert got.groupby("key")["cnt"].first().to_dict() == pdf.groupby("key")["id"].count().to_dict()
    # the rows meet their key's total on (key, salt): the hot key is spread over many tasks
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "Join Inner, ((key" in plan


def test_orphans_split_a_hot_foreign_key(skew_conf):
    spark = skew_conf
    child = _hot(spark).withColumnRenamed("key", "fk")
    parent = spark.range(0, 1000, 2).withColumnRenamed("id", "pk").withColumn("x", F.lit(1))
    out = V.orphans(child, "fk", parent, "pk", keep=["id", "fk"])
    pdf = child.toPandas()
    want = pdf[pdf.fk % 2 == 1]
    assert out.count() == len(want)
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_survivor_per_hot_group(skew_conf):
    spark = skew_conf
    df = _hot(spark).withColumn("v", (F.col("id") * 7919) % 10007)
    got = {r.key: (r.v, r.id) for r in first_per_group(df, ["key"], ["v"]).collect()}
    pdf = df.toPandas().sort_values(["key", "v", "id"]).groupby("key").first()
    assert got == {k: (int(r.v), int(r.id)) for k, r in pdf.iterrows()}


def test_top_customers_with_a_hot_customer(skew_conf):
    spark = skew_conf
    orders = _hot(spark).select(F.col("id"), F.col("key").alias("customer_id"),
                                (F.col("id") % 100 + 1).cast("decimal(12,2)").alias("total_amount"))
    customers = spark.range(1000).select(F.col("id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"))
    a = [tuple(r) for r in Q.top_customers(customers, orders, 5).collect()]
    b = [tuple(r) for r in Q.top_customers_preagg(customers, orders, 5).collect()]
    pdf = orders.toPandas()
    pdf["total_amount"] = pdf["total_amount"].astype(float)
    want = pdf.groupby("customer_id")["total_amount"].sum().sort_values(ascending=False).head(1)
    assert a == b and a[0][0] == 7 and a[0][2] == pytest.approx(float(want.iloc[0]))


def test_salted_left_joins_equal_plain(spark):
    from tillroll.plans import nominations as N
    from tillroll.registry import _nominations
    from tillroll.sources import adapters as A
    sf = "/root/testdata/sf0.001"
    sel, master, nominated, _ = _nominations(spark, sf)
    dom = N.dominant_brand(N.event_brand_categories(nominated, master))
    import datetime
    plain = N.flag_nominations(sel, dom, nominated)
    salted = N.flag_nominations(sel, dom, nominated, salts=8)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, salted.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    monday = datetime.date(1998, 6, 1)
    rr = A.re_run_events(spark, sf)
    a = N.with_rerun(plain, rr, True, monday, 0)
    b = N.with_rerun(plain, rr, True, monday, 0, salts=8)
    assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def test_hashed_duplicates_spread_a_hot_text_over_tasks(skew_conf):
    """A text on a third of the rows: its rows come out of many tasks, and unique texts aren't shuffled."""
    spark = skew_conf
    df = spark.range(N).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot " * 20))
                               .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    out = V.duplicate_keys(df, "text", "id", hashed=True)
    assert out.count() == N // 3 and {r.cnt for r in out.select("cnt").distinct().collect()} == {N // 3}
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= N // 6          # 8 salts over 8 partitions
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in text and "_class" in text


def test_hot_event_of_the_flags_is_in_several_tasks(skew_conf):
    from tillroll.plans import nominations as P
    spark = skew_conf
    selected = spark.range(N).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("parent_event_code"),
                                     F.col("id").alias("line_item_id"))
    dominant = spark.createDataFrame([(7, "b", "c")], "parent_event_code long, brand_name string, category string")
    nominated = selected.where("line_item_id % 2 = 0")
    out = P.flag_nominations(selected, dominant, nominated, salts=8)
    hot = out.where("parent_event_code = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in hot) == N // 3 + 1 and len(hot) >= 4     # and the row of id 7


def test_hot_customer_is_in_several_tasks(skew_conf):
    spark = skew_conf
    orders = _hot(spark).select("id", F.col("key").alias("customer_id"), F.lit(1).cast("decimal(12,2)").alias("total_amount"))
    customers = spark.range(1000).select("id", F.col("id").cast("string").alias("name"))
    plain, salted = Q.top_customers(customers, orders, 5), Q.top_customers(customers, orders, 5, salts=8)
    assert plain.collect() == salted.collect()
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
