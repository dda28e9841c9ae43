"""Catalog operators and the sales generator."""

import pytest
from pyspark.sql import functions as F

from tillroll.plans import orders as Q
from tillroll.sources import catalog as IO
from tillroll.sources.generate import generate_sales
from tillroll.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_materialize_passthrough_and_named(spark):
    df = spark.range(5)
    assert IO.materialize(df, None) is df
    out = IO.materialize(df, "io_mat")
    assert out.count() == 5 and spark.catalog.tableExists("io_mat")


def test_materialize_may_rewrite_the_table_it_reads(spark):
    IO.overwrite(spark.range(3), "io_self")
    again = IO.materialize(spark.table("io_self").withColumn("id", F.col("id") + 10), "io_self")
    assert sorted(r.id for r in again.collect()) == [10, 11, 12]


def test_resolve_source(spark):
    IO.overwrite(spark.range(2), "io_src_b")
    assert IO.resolve_source(spark, ["io_src_missing", "io_src_b"]).count() == 2
    with pytest.raises(LookupError):
        IO.resolve_source(spark, ["io_src_missing"])


def test_ctas_records_statistics(spark):
    IO.ctas(spark.range(7), "io_ctas")
    stats = [r for r in IO.describe(spark, "io_ctas").collect() if r.col_name == "Statistics"]
    assert stats and "7 rows" in stats[0].data_type


def test_insert_select_and_schema(spark):
    IO.create_schema(spark, "io_schema")
    IO.overwrite(spark.range(1), "io_schema.t")
    IO.insert_select(spark.range(2), "io_schema.t")
    assert spark.table("io_schema.t").count() == 3
    IO.insert_select(spark.range(2), "io_schema.t", truncate=True)
    assert spark.table("io_schema.t").count() == 2
    IO.drop_table(spark, "io_schema.t")
    assert not spark.catalog.tableExists("io_schema.t")


def test_bucketed_layout_aggregates_without_exchange(spark):
    from tillroll.sources import adapters as A
    laid = IO.write_layout(A.orders(spark, SF), "io_orders_bucketed", ["customer_id"], 4, ["created_at"])
    plan = Q.customer_spend(laid)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_checkpoint_cuts_lineage(spark):
    df = IO.checkpoint(spark.range(4).withColumn("x", F.col("id") * 2))
    assert df.count() == 4
    assert "LogicalRDD" in df._jdf.queryExecution().logical().toString()


def test_generated_sales(spark):
    orders = table(spark, SF, "orders")
    g1 = generate_sales(orders, "o_orderkey", "o_custkey", "o_orderdate", seed=7)
    g2 = generate_sales(orders.repartition(3), "o_orderkey", "o_custkey", "o_orderdate", seed=7)
    assert g1.count() == orders.count()
    assert sorted(map(tuple, g1.collect())) == sorted(map(tuple, g2.collect()))
    s = g1.agg(F.min("amount"), F.max("amount"), F.min("quantity"), F.max("quantity"),
               F.countDistinct("customer_id"), F.max(F.col("discount_amount") / F.col("amount"))).first()
    assert 5 <= s[0] and s[1] <= 2000 and s[2] == 1 and s[3] == 5
    assert s[4] < g1.count()                      # customers repeat
    assert s[5] <= 0.2 + 1e-9


def test_create_table_with_defaults(spark):
    from tillroll.sources.schemas import TRACKER_DEFAULTS
    IO.create_table(spark, "io_tasks", "id bigint, status string, priority int, cost decimal(12,2)",
                    TRACKER_DEFAULTS, replace=True)
    spark.sql("INSERT INTO io_tasks (id, cost) VALUES (1, 2.50)")
    r = spark.table("io_tasks").first()
    assert (r.id, r.status, r.priority, float(r.cost)) == (1, "todo", 3, 2.5)


def test_load_calendar_by_insert_select(spark):
    from tillroll.plans.calendar import load_calendar
    cal = load_calendar(spark, "io_calendar", "2024-01-01", "2024-12-31")
    assert cal.count() == 366
    assert load_calendar(spark, "io_calendar", "2024-01-01", "2024-01-31").count() == 31


def test_temp_view_and_sql(spark):
    from tillroll.plans.sales import with_order_year
    from tillroll.sources import adapters as A
    s = A.sales_transactions(spark, SF, ["amount", "quantity", "transaction_date", "payment_mode"])
    IO.temp_view(with_order_year(s), "tmp_sales", ["order_year", "amount", "quantity", "payment_mode"])
    out = spark.sql("SELECT payment_mode, SUM(amount * quantity) AS total_amount, COUNT(*) AS transactions "
                    "FROM tmp_sales GROUP BY payment_mode")
    assert out.count() == 5
    IO.drop_view(spark, "tmp_sales")
    assert not spark.catalog.tableExists("tmp_sales")


def test_select_present_row_count_and_views(spark):
    from tillroll.operators.relational import select_present
    from tillroll.sources.tables import register_views
    df = spark.range(3).withColumn("a", F.lit(1))
    assert select_present(df, ["a", "zzz", "id"]).columns == ["a", "id"]
    assert IO.row_count(df).first().cnt == 3
    register_views(spark, SF, ["nation", "region"])
    assert spark.sql("SELECT COUNT(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").first().n == 25


def _files(spark, name):
    import glob
    place = [r.data_type for r in IO.describe(spark, name).collect() if r.col_name == "Location"][0]
    return place, glob.glob(place.removeprefix("file:") + "/*.parquet")


def test_named_tables_are_managed_and_replaced_in_place(spark):
    import glob
    IO.materialize(spark.range(3), "io_durable")
    out = IO.materialize(spark.range(4), "io_durable")
    assert out.count() == 4
    info = {r.col_name: r.data_type for r in IO.describe(spark, "io_durable").collect()}
    assert info["Type"] == "MANAGED"
    place, _ = _files(spark, "io_durable")
    assert len(glob.glob(place.removeprefix("file:").rsplit("/", 1)[0] + "/io_durable*")) == 2
    # the table and the version before, for readers that are still at it
    IO.drop_table(spark, "io_durable")
    assert not glob.glob(place.removeprefix("file:"))


def test_a_replacement_that_broke_off_is_finished(spark):
    spark.range(5).write.saveAsTable("io_broken__next")          # the old table was dropped, the rename didn't happen
    out = IO.materialize(spark.range(6), "io_broken")
    assert out.count() == 6 and not spark.catalog.tableExists("io_broken__next")


def test_a_bucketed_write_makes_one_file_a_bucket(spark):
    df = spark.range(0, 2000, 1, 20).withColumn("k", F.col("id") % 97)
    IO.write_layout(df, "io_buckets", ["k"], 8, ["id"])
    assert len(_files(spark, "io_buckets")[1]) == 8


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tillroll import session
    monkeypatch.setattr(session, "is_local", lambda s: False)
    if spark.conf.get("spark.checkpoint.dir", None):
        assert session.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    else:
        with pytest.raises(RuntimeError):
            session.shared_dir(spark)


def test_generated_rows_stand_behind_the_originals(spark):
    from tillroll.sources.generate import append_generated
    a = spark.createDataFrame([("T1", 1.0, "x")], "transaction_id string, amount double, extra string")
    g = generate_sales(table(spark, SF, "orders"), "o_orderkey", "o_custkey", "o_orderdate")
    out = append_generated(a, g, 5)
    assert out.rdd.getNumPartitions() == 5 and out.count() == 1 + g.count()
    assert out.columns == a.columns and out.where("transaction_id = 'T1'").first().extra == "x"


def test_a_shared_folder_is_a_warehouse_on_a_cluster(spark, monkeypatch):
    """Off a local master a warehouse without a remote scheme is tried out, not refused by its name."""
    monkeypatch.setattr(IO, "is_local", lambda _: False)
    IO.materialize(spark.range(3), "io_on_a_mount")
    out = IO.materialize(spark.table("io_on_a_mount").union(spark.range(3, 5)), "io_on_a_mount")
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]
    IO.drop_table(spark, "io_on_a_mount")
    monkeypatch.setattr(IO, "_read_by_a_task", lambda *_: False)
    with pytest.raises(RuntimeError, match="machine-local"):
        IO.materialize(spark.range(3), "io_on_a_mount")
