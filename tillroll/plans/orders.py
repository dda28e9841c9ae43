"""Order analytics: top customers, top category per month, order value, returns.

Inputs are the logical tables ``customers(id, name)``,
``orders(id, customer_id, total_amount, created_at)``,
``order_items(order_id, product_id, quantity, ...)``,
``products(id, category_id, ...)``, ``categories(id, name)`` and
``returns(order_id, returned_at)``.  Months are DATEs (first of month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_start
from tillroll.functions.money import mean_of
from tillroll.operators.relational import best_per_group, left_join, top_k, union_all


# --------------------------------------------------------------------------- Q11 / Q12
def top_customers(customers: DataFrame, orders: DataFrame, k: int = 3, salts: int | None = None) -> DataFrame:
    """Join, then aggregate per customer, then top-k by spend (ties: lower id).

    AQE can't split a hot customer here, since the aggregate above reuses the
    join's partitioning; ``salts`` spreads the orders of customers measured as
    very common over that many tasks."""
    c = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"),
                         F.lit(True).alias("_known"))
    spend = (left_join(orders.select("id", "customer_id", "total_amount"), c, ["customer_id"], salts).where("_known")
             .groupBy("customer_id", "customer_name")
             .agg(F.sum("total_amount").cast("double").alias("total_spent")))
    return top_k(spend, [F.desc_nulls_last("total_spent"), F.asc_nulls_last("customer_id")], k)


def customer_spend(orders: DataFrame) -> DataFrame:
    """Per-customer spend (the pre-aggregate of Q12); partial sums are combined
    before the shuffle, so the exchange carries one row per customer per task."""
    return orders.groupBy("customer_id").agg(F.sum("total_amount").alias("total_spent"))


def top_customers_preagg(customers: DataFrame, orders: DataFrame, k: int = 3) -> DataFrame:
    """Aggregate orders first, then join the (much smaller) result."""
    spend = customer_spend(orders)
    c = customers.select(F.col("id").alias("c_id"), F.col("name").alias("customer_name"))
    j = spend.join(c, F.col("customer_id") == F.col("c_id"))
    out = j.select("customer_id", "customer_name", F.col("total_spent").cast("double").alias("total_spent"))
    return top_k(out, [F.desc_nulls_last("total_spent"), F.asc_nulls_last("customer_id")], k)


def spend_of(joined: DataFrame) -> DataFrame:
    """Spend per customer of orders that carry the customer's name; no exchange where they are bucketed by customer."""
    return joined.groupBy("customer_id", "customer_name").agg(F.sum("total_amount").cast("double").alias("total_spent"))


def top_spenders(parts: list[DataFrame], k: int = 3) -> DataFrame:
    """Top-k over parts that hold different customers."""
    return top_k(union_all(parts), [F.desc_nulls_last("total_spent"), F.asc_nulls_last("customer_id")], k)


# --------------------------------------------------------------------------- Q13 / Q14
def monthly_category_qty(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """SUM(quantity) per (month of order, category).

    Quantities are summed per (month, product) before the products are joined,
    so that join meets one row per product and month, not one per line."""
    o = orders.select(F.col("id").alias("o_id"), month_start("created_at").alias("month"))
    i = items.select("order_id", "product_id", "quantity")
    p = products.select(F.col("id").alias("p_id"), "category_id")
    sold = (o.join(i, F.col("o_id") == F.col("order_id"))
            .groupBy("month", "product_id").agg(F.sum("quantity").alias("quantity")))
    return (sold.join(p, F.col("p_id") == F.col("product_id"))
            .groupBy("month", "category_id")
            .agg(F.sum("quantity").cast("bigint").alias("total_quantity")))


def _winner_per_month(monthly: DataFrame) -> DataFrame:
    # ties: the lower category id wins, a NULL category last
    return best_per_group(monthly, ["month"],
                          [F.desc("total_quantity"), F.asc_nulls_last("category_id")])


def top_category_per_month(orders: DataFrame, items: DataFrame, products: DataFrame,
                           categories: DataFrame) -> DataFrame:
    """Most-sold category per month.  LEFT join for the name: a winner with no
    (or an unknown) category is kept with a NULL name."""
    best = _winner_per_month(monthly_category_qty(orders, items, products))
    cat = categories.select(F.col("id").alias("cat_id"), F.col("name").alias("category_name"))
    return (best.join(cat, F.col("category_id") == F.col("cat_id"), "left")
            .select("month", "category_id", "category_name", "total_quantity").orderBy("month"))


def top_category_per_month_reuse(monthly: DataFrame, categories: DataFrame) -> DataFrame:
    """Same ranking over a stored monthly summary; INNER join for the name, so a
    month whose winner has no category disappears."""
    best = _winner_per_month(monthly)
    cat = categories.select(F.col("id").alias("cat_id"), F.col("name").alias("category_name"))
    return (best.join(cat, F.col("category_id") == F.col("cat_id"))
            .select("month", "category_id", "category_name", "total_quantity").orderBy("month"))


# --------------------------------------------------------------------------- Q15 .. Q17
def monthly_order_stats(orders: DataFrame) -> DataFrame:
    """avg, sum and count of order totals per month, in one aggregation."""
    agg = (orders.groupBy(month_start("created_at").alias("month"))
           .agg(F.sum("total_amount").alias("_sum"), F.count(F.lit(1)).alias("orders_count")))
    return agg.select("month",
                      mean_of("_sum", "orders_count").alias("avg_order_value"),
                      F.col("_sum").cast("double").alias("month_total_revenue"),
                      "orders_count").orderBy("month")


def avg_order_value_by_month(orders: DataFrame) -> DataFrame:
    return monthly_order_stats(orders).select("month", "avg_order_value")


def avg_monthly_revenue_from_stats(stats: DataFrame) -> DataFrame:
    """Mean over the months present (months without orders are not zeros)."""
    return stats.agg(
        (F.sum(F.col("month_total_revenue").cast("decimal(22,2)")).cast("double")
         / F.count(F.lit(1))).alias("avg_monthly_revenue"),
        F.count(F.lit(1)).alias("months_count"))


def avg_monthly_revenue(orders: DataFrame) -> DataFrame:
    monthly = (orders.groupBy(month_start("created_at").alias("month"))
               .agg(F.sum("total_amount").alias("month_total_revenue")))
    return monthly.agg(
        (F.sum("month_total_revenue").cast("double") / F.count(F.lit(1))).alias("avg_monthly_revenue"),
        F.count(F.lit(1)).alias("months_count"))


# --------------------------------------------------------------------------- Q18 / Q19
def returned_orders_by_month(returns: DataFrame) -> DataFrame:
    """Distinct returned orders per month of the return.  Spark plans the
    distinct count as an aggregate on (month, order_id) first, so a busy month
    is spread over many tasks before the final count."""
    return (returns.groupBy(month_start("returned_at").alias("month"))
            .agg(F.countDistinct("order_id").alias("returned_orders_count")).orderBy("month"))


def returned_orders_by_month_approx(returns: DataFrame, rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ sketch per month: one pass, fixed memory per group."""
    return (returns.groupBy(month_start("returned_at").alias("month"))
            .agg(F.approx_count_distinct("order_id", rsd).alias("returned_orders_count")).orderBy("month"))


def within_error(exact: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """Exact counts per month, and whether the estimate lies within ``share`` (and one order) of them."""
    estimate = estimate.withColumnRenamed("returned_orders_count", "estimate")
    off = F.abs(F.col("estimate") - F.col("returned_orders_count"))
    return exact.join(estimate, "month").select(
        "month", "returned_orders_count",
        (off <= F.lit(share) * F.col("returned_orders_count") + 1).alias("within_error")).orderBy("month")


def approximation_check(returns: DataFrame, rsd: float = 0.05, sigmas: float = 4.0) -> DataFrame:
    """Exact counts per month, and whether the estimate lies within ``sigmas`` standard errors of them."""
    return within_error(returned_orders_by_month(returns), returned_orders_by_month_approx(returns, rsd), sigmas * rsd)
