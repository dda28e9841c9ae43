"""Stored summaries: slices taken in, batches replaced, months untouched, sketches merged."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tillroll.plans import incremental as I
from tillroll.plans import orders as Q
from tillroll.sources import adapters as A
from tillroll.sources import catalog as IO

SF = "/root/testdata/sf0.001"
ORDERS = "id long, total_amount decimal(12,2), created_at timestamp_ntz"


def orders(spark, rows):
    return spark.createDataFrame([(i, a, d) for i, (a, d) in enumerate(rows)], "id long, a double, created_at timestamp_ntz") \
        .select("id", F.col("a").cast("decimal(12,2)").alias("total_amount"), "created_at")


def day(m, d=5):
    return dt.datetime(2024, m, d)


def stats(summary, spark):
    return {r.month: (r.orders_count, r.month_total_revenue, r.avg_order_value)
            for r in I.monthly_order_stats(summary, spark).collect()}


@pytest.fixture
def kept(spark):
    summary = I.order_totals("inc_totals")
    yield summary
    IO.drop_table(spark, summary.name)


def test_slices_equal_the_whole(spark, kept):
    r = random.Random(1)
    rows = [(r.randint(1, 10_000) / 100, day(r.randint(1, 12), r.randint(1, 28))) for _ in range(400)] + [(5.0, None), (None, day(3))]
    whole = orders(spark, rows)
    parts = [F.col("id") % 3 == k for k in range(3)]
    I.taken_in_slices(kept, whole, parts)
    want = {x.month: (x.orders_count, x.month_total_revenue, x.avg_order_value)
            for x in Q.monthly_order_stats(whole).collect()}
    assert stats(kept, spark) == want


def test_a_batch_taken_in_again_replaces_itself(spark, kept):
    I.create(kept, orders(spark, [(1.0, day(1)), (2.0, day(2))]), "a")
    for _ in range(3):
        I.take_in(kept, spark, orders(spark, [(10.0, day(2)), (20.0, day(3))]), "b")
    assert {m.month: n for m, (n, *_) in stats(kept, spark).items()} == {1: 1, 2: 2, 3: 1}
    # the corrected batch has no row in February any more, and one in April
    I.take_in(kept, spark, orders(spark, [(30.0, day(3)), (40.0, day(4))]), "b")
    assert {m.month: (n, t) for m, (n, t, _) in stats(kept, spark).items()} == {1: (1, 1.0), 2: (1, 2.0), 3: (1, 30.0), 4: (1, 40.0)}


def test_only_touched_months_are_written(spark, kept):
    I.create(kept, orders(spark, [(1.0, day(m)) for m in range(1, 7)]), "a")
    place = next(r.data_type for r in IO.describe(spark, kept.name).collect() if r.col_name == "Location").removeprefix("file:")

    def files():
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(place + "/period=*/*.parquet")}
    before = files()
    I.take_in(kept, spark, orders(spark, [(1.0, day(4))]), "b")
    after = files()
    assert {p.split("period=")[1][:7] for p in set(before) ^ set(after)} == {"2024-04"}
    assert all(after[p] == before[p] for p in before if "2024-04" not in p)


def test_compaction_changes_no_result(spark, kept):
    I.create(kept, orders(spark, [(float(i), day(1 + i % 4)) for i in range(20)]), "a")
    I.take_in(kept, spark, orders(spark, [(float(i), day(1 + i % 5)) for i in range(20)]), "b")
    before = stats(kept, spark)
    I.compact(kept, spark, dt.date(2024, 4, 1))
    assert stats(kept, spark) == before
    old = spark.table(kept.name).where("period < '2024-04-01'")
    assert {r.batch for r in old.collect()} == {"compacted"} and old.count() == 3


def test_sketches_merge_without_counting_twice(spark):
    summary = I.returned_orders("inc_returns")
    try:
        rows = spark.range(6000).select((F.col("id") % 2000).alias("order_id"),
                                        F.lit(day(1)).cast("timestamp_ntz").alias("returned_at"))
        I.taken_in_slices(summary, rows, [F.col("order_id") % 4 != 0, F.col("order_id") % 3 != 1, F.lit(True)])
        (r,) = I.returned_orders_by_month(summary, spark).collect()
        assert abs(r.returned_orders_count - 2000) <= 4 * I.SKETCH_ERROR * 2000 + 1
    finally:
        IO.drop_table(spark, summary.name)


def test_against_the_tables(spark):
    returns = A.returns(spark, SF)
    summary = I.returned_orders("inc_returns_sf")
    try:
        I.create(summary, returns, "all")
        exact = {r.month: r.returned_orders_count for r in Q.returned_orders_by_month(returns).collect()}
        for r in I.returned_orders_by_month(summary, spark).collect():
            assert abs(r.returned_orders_count - exact[r.month]) <= 4 * I.SKETCH_ERROR * exact[r.month] + 1
    finally:
        IO.drop_table(spark, summary.name)
