"""Sales transactions: cleaning, yearly and per-payment totals, negative lines,
credit/debit validation per customer.

Input: a frame with the sales_transactions columns (``SALES_SCHEMA``); only the
columns an operator reads are required.  Money is summed exactly
(``tillroll.functions.money``) and reported as double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import exact_sum, line_total, opposite_signs, ratio
from tillroll.functions.predicates import all_not_null, contains_ci
from tillroll.operators.relational import top_k


def clean_sales(sales: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column, add ``order_year``.

    Written as a conjunction of IS NOT NULL, which reaches the parquet scan as
    pushed filters (``dropna`` compiles to AtLeastNNonNulls, which does not)."""
    return (sales.where(all_not_null(sales.columns))
            .withColumn("order_year", F.year("transaction_date")))


def with_order_year(sales: DataFrame) -> DataFrame:
    """``order_year`` when present, else derived from the date (source fallback)."""
    if "order_year" in sales.columns:
        return sales
    return sales.withColumn("order_year", F.year("transaction_date"))


def sales_by_year(sales: DataFrame) -> DataFrame:
    s = with_order_year(sales)
    return (s.groupBy("order_year")
            .agg(exact_sum(line_total("amount", "quantity")).alias("total_sales"),
                 F.count(F.lit(1)).alias("transactions"))
            .orderBy("order_year"))


def sales_by_payment(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("payment_mode")
            .agg(exact_sum(line_total("amount", "quantity")).alias("total_amount"),
                 F.count(F.lit(1)).alias("transactions"))
            .orderBy(F.desc_nulls_last("total_amount"), F.asc_nulls_last("payment_mode")))


def negative_transactions(sales: DataFrame, limit: int = 100) -> DataFrame:
    """Lines whose amount and quantity have opposite signs, newest first.  Ties on the date are
    broken by the remaining output columns so the first ``limit`` rows are
    well defined."""
    total = line_total("amount", "quantity")
    out = sales.where(opposite_signs("amount", "quantity")).select(
        "transaction_id", "customer_id", "transaction_date", "amount", "quantity",
        total.cast("double").alias("total_amount"), "payment_mode", "store_location")
    return top_k(out, [F.desc_nulls_last("transaction_date")]
                 + [F.asc_nulls_last(c) for c in ("transaction_id", "customer_id", "amount", "quantity",
                                                  "payment_mode", "store_location")], limit)


def credit_debit_by_customer(sales: DataFrame, max_share: float = 0.1) -> DataFrame:
    """Per customer: credit, debit and total amounts, the credit share and the
    two rule flags.  Credit/debit by substring of the lower-cased payment mode."""
    total = line_total("amount", "quantity")
    zero = F.lit(0)
    agg = sales.groupBy("customer_id").agg(
        exact_sum(F.when(contains_ci("payment_mode", "credit"), total).otherwise(zero)).alias("total_credit"),
        exact_sum(F.when(contains_ci("payment_mode", "debit"), total).otherwise(zero)).alias("total_debit"),
        exact_sum(total).alias("total_amount"))
    return agg.select(
        "customer_id", "total_credit", "total_debit", "total_amount",
        ratio("total_credit", "total_amount").alias("credit_pct"),
        (F.col("total_credit") < F.col("total_debit")).alias("credit_lt_debit"),
        (F.col("total_credit") <= F.lit(max_share) * F.col("total_amount")).alias("credit_le_10pct"))


def credit_debit_violations(sales: DataFrame, max_share: float = 0.1,
                            limit: int | None = 100) -> DataFrame:
    """Customers failing ``credit < debit AND credit <= max_share * total``.

    A customer with neither credit nor debit fails (0 < 0 is false).  Ordered by
    the credit share, highest first; ties by customer id."""
    v = credit_debit_by_customer(sales, max_share)
    v = v.where(~(F.col("credit_lt_debit") & F.col("credit_le_10pct")))
    order = [F.desc_nulls_last("credit_pct"), F.asc_nulls_last("customer_id")]
    return top_k(v, order, limit) if limit else v.orderBy(*order)
