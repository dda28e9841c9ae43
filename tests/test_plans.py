"""Plan-shape tests: the structural choices the operators rely on at scale."""

from tillroll.plans import nominations as N
from tillroll.plans import orders as Q
from tillroll.registry import QUERIES
from tillroll.sources import adapters as A

SF = "/root/testdata/sf0.001"


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def first(lines, needle):
    return next(i for i, line in enumerate(lines) if needle in line)


def test_week_restriction_reaches_the_orders_scan(spark):
    weeks = spark.createDataFrame([(19980601,)], "nsw int")
    m = N._master_cols(N.product_master(A.prod(spark, SF)), weeks, "nsw")
    plan = optimized(m)
    # the condition on the weeks sits below the master's aggregate and below the join with part, on the orders
    at = max(i for i, line in enumerate(plan) if "Filter" in line and "scalar-subquery" in line)
    assert at > first(plan, "Aggregate") and at > first(plan, "Join Inner")
    assert "o_orderkey" in "\n".join(plan[at:])


def test_no_job_runs_while_nomination_plans_are_built(spark):
    """Weeks and common keys are measured by subqueries, when a query runs."""
    sel = A.selected_nominations(spark, SF)
    master = N.product_master(A.prod(spark, SF))
    li = N.line_item_products(N.nominated_products(A.nomination_prod(spark, SF, 19980601), sel, 19980601))
    sc = spark.sparkContext
    sc.setJobGroup("planning", "no job is expected")
    try:
        N.featured_products(li, master)
        N.brand_products(li, master)
        N.category_products(li, master)
        bc = N.event_brand_categories(li, master)
        N.flag_nominations(sel, N.dominant_brand(bc), li, salts=8)
        N.brands_and_categories(sel, bc)
        assert list(sc.statusTracker().getJobIdsForGroup("planning")) == []
        N.featured_products(li, master).count()
        assert len(sc.statusTracker().getJobIdsForGroup("planning")) > 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def scans_of(df):
    """The parquet scans of an executed plan: name -> value of their metrics, one dictionary a scan."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "FileSourceScanExec":
            metrics = node.metrics()
            found.append({k: metrics.apply(k).value() for k in ("numFiles", "numPartitions", "numOutputRows")
                          if metrics.contains(k)})
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_master_stored_by_week_is_read_by_week(spark):
    from tillroll.sources import catalog as IO
    sel = A.selected_nominations(spark, SF)
    li = N.line_item_products(N.nominated_products(A.nomination_prod(spark, SF, 19980601), sel, 19980601))
    stored = IO.write_partitioned(N.product_master(A.prod(spark, SF)), None, ["fis_week_id"],
                                  path=IO.scratch_path(spark, "dpp_master"))
    df = N.category_products(li, stored)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        filters = [part.split("]")[0] for part in physical(df).split("PartitionFilters: [")[1:]]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("array_contains(" in f and "fis_week_id" in f for f in filters)
    rows = df.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["category_products"](spark, SF).collect()))
    read = [s["numPartitions"] for s in scans_of(df) if "numPartitions" in s]
    assert stored.select("fis_week_id").distinct().count() > 50 and read and max(read) == 1


def test_nominated_week_is_pushed_to_the_scans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = physical(QUERIES["nominated_products"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [part.split("]")[0] for part in text.split("PushedFilters: [")[1:]]
    assert any("GreaterThanOrEqual(o_orderdate,1998-06-01" in p and "LessThan(o_orderdate,1998-06-08" in p for p in pushed)
    assert any("EqualTo(l_returnflag,A)" in p for p in pushed)


def test_fused_product_sets_derive_the_expansion_once(spark):
    sel = A.selected_nominations(spark, SF)
    master = N.product_master(A.prod(spark, SF))
    li = N.line_item_products(N.nominated_products(A.nomination_prod(spark, SF), sel, 19980601))
    fused = physical(N.nomination_product_sets(li, master))
    three = physical(N.final_nomination_products(N.featured_products(li, master), N.brand_products(li, master),
                                                 N.category_products(li, master)))
    assert "FileScan" not in fused and three.count("FileScan parquet") >= 9


def test_quantities_are_summed_before_they_meet_products(spark):
    for name in ("units_by_attr", "top_category_per_month"):
        plan = optimized(QUERIES[name](spark, SF))
        depth = {line: len(line) - len(line.lstrip(" :+-")) for line in plan}
        # the products' join: the deepest join above an aggregate on the product
        sums = [i for i, line in enumerate(plan) if "Aggregate" in line and "product_id" in line]
        assert sums and any("Join" in line and depth[line] < depth[plan[sums[0]]] for line in plan[:sums[0]]), name


def test_the_ledger_shuffles_line_items_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = A.sales_transactions(spark, SF, ["transaction_id", "store_location", "amount"])
        plan = plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        assert "hashpartitioning(c_nationkey" in plan and "l_extendedprice" not in plan.split("hashpartitioning(c_nationkey")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_preaggregation_happens_before_the_join(spark):
    plan = optimized(Q.top_customers_preagg(A.customers(spark, SF), A.orders(spark, SF)))
    assert first(plan, "Aggregate") > first(plan, "Join Inner")
    plan = optimized(Q.top_customers(A.customers(spark, SF), A.orders(spark, SF)))
    assert first(plan, "Aggregate") < first(plan, "Join Inner")


def test_sales_view_joins_only_what_it_needs(spark):
    text = physical(QUERIES["sales_by_year"](spark, SF))
    assert "lineitem.parquet" in text and "orders.parquet" in text
    assert "part.parquet" not in text and "customer.parquet" not in text


def test_scans_read_only_used_columns(spark):
    text = physical(QUERIES["top_customers_preagg"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_returns_filter_is_pushed_to_the_scan(spark):
    text = physical(QUERIES["returned_orders_by_month"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text


def test_suite_summary_does_not_build_detail_strings(spark):
    text = "\n".join(optimized(QUERIES["validation_summary"](spark, SF)))
    assert "concat_ws" not in text


def test_anti_join_equals_left_join_is_null(spark):
    from pyspark.sql import functions as F
    from tillroll.operators import quality as V
    # a parent subset, so the relation has orphans (a test fixture derived from the tables)
    projects = A.tracker_projects(spark, SF).where(F.col("id") % 7 != 0)
    tasks = A.tracker_tasks(spark, SF)
    anti = V.orphans(tasks, "project_id", projects, "id", keep=["project_id", "line"])
    t, p = tasks.alias("t"), projects.alias("p")
    left = (t.join(p, F.col("t.project_id") == F.col("p.id"), "left")
            .where(F.col("t.project_id").isNotNull() & F.col("p.id").isNull())
            .select(F.lit("reference to missing parent").alias("check"), "t.project_id", "t.line"))
    got, want = sorted(map(tuple, anti.collect())), sorted(map(tuple, left.collect()))
    assert got == want and len(got) > 0


def test_left_and_inner_top_category_agree_without_null_categories(spark):
    o, i, p, c = A.orders(spark, SF), A.order_items(spark, SF), A.products(spark, SF), A.categories(spark, SF)
    left = Q.top_category_per_month(o, i, p, c)
    inner = Q.top_category_per_month_reuse(Q.monthly_category_qty(o, i, p), c)
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, inner.collect()))
