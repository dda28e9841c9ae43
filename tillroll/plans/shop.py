"""Shop queries: units per product attribute, the top attribute, distinct buyers.

Inputs: ``order_products(order_id, product_id, quantity)``,
``products(id, itemname, item_colour, ...)``, ``orders(id, customer_id, ...)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.relational import top_k


def units_by_attr(lines: DataFrame, products: DataFrame, attr: str = "item_colour") -> DataFrame:
    """SUM(quantity) per product attribute.  Quantities are summed per product
    first (map-side, so a hot product costs a row per task), then joined."""
    sold = lines.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    p = products.select(F.col("id").alias("p_id"), F.col(attr))
    return (sold.join(p, F.col("product_id") == F.col("p_id"))
            .groupBy(attr).agg(F.sum("quantity").cast("bigint").alias("total_sold")))


def top_attr(lines: DataFrame, products: DataFrame, attr: str = "item_colour",
             k: int = 1) -> DataFrame:
    """Most-sold attribute value(s); ties broken by the value."""
    return top_k(units_by_attr(lines, products, attr),
                 [F.desc_nulls_last("total_sold"), F.asc_nulls_last(attr)], k)


def distinct_buyers(orders: DataFrame, lines: DataFrame, products: DataFrame,
                    item: str, name_col: str = "itemname") -> DataFrame:
    """Number of distinct customers who ordered ``item``.  The product filter is
    applied before the joins (pushed into the scan), and the lines are reduced
    to distinct order ids with a semi join before meeting the orders."""
    wanted = products.where(F.col(name_col) == item).select(F.col("id").alias("p_id"))
    hit_orders = lines.join(wanted, F.col("product_id") == F.col("p_id"), "left_semi") \
        .select(F.col("order_id").alias("hit_id"))
    buyers = orders.join(hit_orders, F.col("id") == F.col("hit_id"), "left_semi")
    return buyers.agg(F.countDistinct("customer_id").alias("num_customers"))
