"""Order analytics on a hand-made fixture, plus metamorphic pairs."""

from datetime import date, datetime

import pytest

from tillroll.plans import orders as Q


@pytest.fixture(scope="module")
def shop(spark):
    customers = spark.createDataFrame([(1, "Ann"), (2, "Bo"), (3, "Cy"), (4, "Di")], "id bigint, name string")
    orders = spark.createDataFrame([
        (10, 1, "100.00", datetime(2024, 1, 5)), (11, 2, "50.00", datetime(2024, 1, 20)),
        (12, 1, "25.00", datetime(2024, 2, 2)), (13, 3, "75.00", datetime(2024, 2, 10)),
        (14, 4, "10.00", datetime(2024, 3, 1))],
        "id bigint, customer_id bigint, total_amount string, created_at timestamp")
    orders = orders.selectExpr("id", "customer_id", "CAST(total_amount AS DECIMAL(12,2)) AS total_amount",
                               "created_at")
    products = spark.createDataFrame([(1, 1, "p1"), (2, 2, "p2"), (3, None, "p3")],
                                     "id bigint, category_id bigint, name string")
    categories = spark.createDataFrame([(1, "Toys"), (2, "Books")], "id bigint, name string")
    items = spark.createDataFrame([(10, 1, 3), (11, 2, 1), (12, 2, 4), (13, 1, 1), (14, 3, 2)],
                                  "order_id bigint, product_id bigint, quantity int")
    returns = spark.createDataFrame([(10, datetime(2024, 2, 1)), (10, datetime(2024, 2, 3)),
                                     (12, datetime(2024, 2, 20)), (13, datetime(2024, 3, 4))],
                                    "order_id bigint, returned_at timestamp")
    return customers, orders, items, products, categories, returns


def test_top_customers(shop):
    customers, orders, *_ = shop
    expect = [(1, "Ann", 125.0), (3, "Cy", 75.0), (2, "Bo", 50.0)]
    assert [tuple(r) for r in Q.top_customers(customers, orders, 3).collect()] == expect
    assert [tuple(r) for r in Q.top_customers_preagg(customers, orders, 3).collect()] == expect


def test_top_category_left_keeps_null_category(shop):
    _, orders, items, products, categories, _ = shop
    out = Q.top_category_per_month(orders, items, products, categories).orderBy("month").collect()
    assert [tuple(r) for r in out] == [(date(2024, 1, 1), 1, "Toys", 3), (date(2024, 2, 1), 2, "Books", 4),
                                       (date(2024, 3, 1), None, None, 2)]


def test_top_category_inner_drops_null_category(shop):
    _, orders, items, products, categories, _ = shop
    monthly = Q.monthly_category_qty(orders, items, products)
    out = Q.top_category_per_month_reuse(monthly, categories).orderBy("month").collect()
    assert [tuple(r) for r in out] == [(date(2024, 1, 1), 1, "Toys", 3), (date(2024, 2, 1), 2, "Books", 4)]


def test_average_order_value(shop):
    orders = shop[1]
    out = Q.avg_order_value_by_month(orders).orderBy("month").collect()
    assert [r.avg_order_value for r in out] == [75.0, 50.0, 10.0]
    stats = Q.monthly_order_stats(orders).orderBy("month").collect()
    assert [(r.avg_order_value, r.month_total_revenue, r.orders_count) for r in stats] == \
        [(75.0, 150.0, 2), (50.0, 100.0, 2), (10.0, 10.0, 1)]


def test_average_monthly_revenue(shop):
    orders = shop[1]
    r = Q.avg_monthly_revenue(orders).collect()[0]
    assert r.months_count == 3 and r.avg_monthly_revenue == pytest.approx(86.666667, abs=1e-6)
    r2 = Q.avg_monthly_revenue_from_stats(Q.monthly_order_stats(orders)).collect()[0]
    assert tuple(r2) == tuple(r)


def test_returned_orders(shop):
    returns = shop[5]
    out = Q.returned_orders_by_month(returns).orderBy("month").collect()
    assert [tuple(r) for r in out] == [(date(2024, 2, 1), 2), (date(2024, 3, 1), 1)]
    approx = Q.returned_orders_by_month_approx(returns).orderBy("month").collect()
    assert [tuple(r) for r in approx] == [(date(2024, 2, 1), 2), (date(2024, 3, 1), 1)]


def test_top_category_plan_limits_rows_per_month(spark):
    from tillroll.registry import QUERIES
    plan = QUERIES["top_category_per_month"](spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text or "Window" in text


def test_top_k_is_take_ordered(spark):
    from tillroll.registry import QUERIES
    text = QUERIES["top_customers_preagg"](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .sparkPlan().toString()
    assert "TakeOrderedAndProject" in text
