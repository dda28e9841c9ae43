"""Logical tables of the analyses, derived from the driver's TPC-H-like tables.

Each adapter is a narrow projection (plus the joins it needs and no more), so the
scan reads only the columns the analysis uses.  The same derivations are spelled
out in SQL in ``tillroll.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import week_id
from tillroll.functions.money import money
from tillroll.operators.skew import salted_join, tasks_for
from tillroll.sources.tables import table

# Payment mode by the first digit of o_orderpriority.
PAYMENT_MODES = {"1": "Credit Card", "2": "Debit Card", "3": "Cash", "4": "PayPal", "5": "Gift Card"}


def tasks_of(spark: SparkSession, d: str, name: str) -> int | None:
    """Tasks for a step over all rows of a driver's table (see ``skew.tasks_for``); they are counted in its files' footers."""
    return tasks_for(table(spark, d, name).count())


# --------------------------------------------------------------------------- order analytics
def customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"),
                                              F.col("c_name").alias("name"))


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderdate").alias("created_at"))


def order_items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(10,2)").alias("unit_price"))


def _brand_number(c):
    return F.regexp_extract(F.col(c), r"([0-9]+)$", 1).cast("bigint")


def products(spark: SparkSession, d: str) -> DataFrame:
    """category = brand number; colour = first word of the name."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        _brand_number("p_brand").alias("category_id"),
        F.col("p_name").alias("name"),
        F.split(F.col("p_name"), " ").getItem(0).alias("colour"))


def categories(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "part")
            .select(_brand_number("p_brand").alias("id"), F.col("p_brand").alias("name"))
            .distinct())


def returns(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("returned_at")))


# --------------------------------------------------------------------------- sales ledger
SALES_COLUMNS = ("transaction_id", "customer_id", "customer_name", "product_id", "product_name",
                 "category", "amount", "quantity", "transaction_date", "payment_mode",
                 "store_location", "discount_applied", "discount_amount", "loyalty_points_earned",
                 "is_return", "sales_rep")

# which source tables each column needs (l = lineitem, o = orders, c = customer, n = nation, p = part)
_NEEDS = {"customer_id": "o", "customer_name": "oc", "product_name": "p", "category": "p",
          "transaction_date": "o", "payment_mode": "o", "store_location": "ocn"}


def _payment_mode():
    digit = F.substring(F.col("o_orderpriority"), 1, 1)
    expr = None
    for k, v in PAYMENT_MODES.items():
        expr = (F.when(digit == k, v) if expr is None else expr.when(digit == k, v))
    return expr


def sales_transactions(spark: SparkSession, d: str,
                       columns: Iterable[str] | None = None) -> DataFrame:
    """One row per line item; returns post a negative quantity.

    Only the tables the requested columns need are joined: every join here is
    on a foreign key, so a join whose columns are unused would only cost a
    shuffle of the fact table.
    """
    cols = list(columns or SALES_COLUMNS)
    need = set("".join(_NEEDS.get(c, "") for c in cols))
    df = table(spark, d, "lineitem")
    if "o" in need:
        # the order's own lookups come first: the fact table is then shuffled once, on the order key
        head = table(spark, d, "orders")
        if "c" in need:
            buyer = table(spark, d, "customer")
            if "n" in need:
                buyer = buyer.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            head = head.join(buyer, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(head, F.col("l_orderkey") == F.col("o_orderkey"))
    if "p" in need:
        df = df.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    exprs = {
        "transaction_id": F.concat(F.lit("T"), F.col("l_orderkey").cast("string"), F.lit("-"),
                                   F.col("l_linenumber").cast("string")),
        "customer_id": F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        "customer_name": F.col("c_name"),
        "product_id": F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        "product_name": F.col("p_name"),
        "category": F.col("p_type"),
        "amount": F.col("l_extendedprice"),
        "quantity": F.col("l_quantity").cast("int") * sign,
        "transaction_date": F.col("o_orderdate"),
        "payment_mode": _payment_mode(),
        "store_location": F.col("n_name"),
        "discount_applied": F.col("l_discount") > 0,
        "discount_amount": F.round(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"),
                                   2).cast("double"),
        "loyalty_points_earned": F.floor(F.col("l_extendedprice") / 10).cast("int"),
        "is_return": F.col("l_returnflag") == "R",
        "sales_rep": F.concat(F.lit("SR"), F.col("l_suppkey").cast("string")),
    }
    return df.select(*[exprs[c].alias(c) for c in cols])


# --------------------------------------------------------------------------- shop (colour queries)
def shop_order_products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"))


def shop_products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("itemname"),
        F.split(F.col("p_name"), " ").getItem(0).alias("item_colour"))


def shop_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_price"))


# --------------------------------------------------------------------------- project tracker
def tracker_users(spark: SparkSession, d: str, with_created: bool = False) -> DataFrame:
    """Customers as users.  ``with_created`` adds ``created_at`` = the first
    order date (an aggregate per customer, LEFT joined: users without orders
    keep a NULL)."""
    users = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    if not with_created:
        return users
    first = (table(spark, d, "orders").groupBy(F.col("o_custkey").alias("_uid"))
             .agg(F.min("o_orderdate").alias("created_at")))
    return users.join(first, F.col("id") == F.col("_uid"), "left").drop("_uid")


def tracker_projects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"))


def tracker_tasks(spark: SparkSession, d: str, with_project: bool = False) -> DataFrame:
    """Line items as tasks.  ``with_project`` adds the order's date and priority
    through a LEFT join, so tasks whose project is missing are kept."""
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("project_id"), F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("assignee_id"), F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").cast("date").alias("due_date"))
    if not with_project:
        return li
    o = table(spark, d, "orders").select(
        F.col("o_orderkey"), F.col("o_orderdate").alias("created_at"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"))
    return li.join(o, li["project_id"] == o["o_orderkey"], "left").drop("o_orderkey")


# --------------------------------------------------------------------------- nominations
def _order_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Week of each order, computed once per order (before any join to lines)."""
    return table(spark, d, "orders").select("o_orderkey", week_id("o_orderdate").alias("_week"))


def nomination_prod(spark: SparkSession, d: str, week: int | None = None,
                    event_types: Iterable[str] | None = None) -> DataFrame:
    """Products nominated per order (nomination = order): event type AAA for
    lines with return flag A, week = Monday of the order date.

    ``week`` (yyyymmdd of a Monday) and ``event_types`` restrict the rows by what
    the scans hold, a range of order dates and the return flag, so other weeks
    are not read; without them all weeks and types are there."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    if week is not None:
        monday = _dt.datetime.strptime(str(week), "%Y%m%d")
        kind = o.schema["o_orderdate"].dataType
        o = o.where((F.col("o_orderdate") >= F.lit(str(monday)).cast(kind))
                    & (F.col("o_orderdate") < F.lit(str(monday + _dt.timedelta(7))).cast(kind)))
    if event_types is not None and set(event_types) == {"AAA"}:
        li = li.where(F.col("l_returnflag") == "A")
    o = o.select("o_orderkey", week_id("o_orderdate").alias("_week"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("_week").alias("fis_week_id"),
        F.when(F.col("l_returnflag") == "A", "AAA").otherwise("BBB").alias("event_type_code"),
        F.col("l_partkey").alias("prod_level_code"),
        F.col("l_orderkey").alias("nomination_code"),
        F.col("_week").alias("event_start_week"))


def prod(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    """Weekly product master: a product is listed once in each week it was
    ordered (the narrow (week, product) distinct runs before the attributes
    are joined on).

    The product attributes are renamed on the part side, before the join, so
    the output needs no projection above the join: a semi join on the week
    (see ``plans.nominations``) is then pushed through the joins down to the
    orders scan.

    ``tasks`` (``tasks_of`` the line items) is for a master of all weeks: it deals
    the rows of each step to so many tasks.  A master of a few weeks does without,
    since its few orders are broadcast and the line items stay where they are."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select(
        F.col("p_partkey").alias("prod_group_code"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("prod_merch_l10_code"),
        F.lower(F.col("p_type")).alias("prod_merch_l10_desc"),
        F.col("p_name").alias("prod_desc"))
    weeks = _order_weeks(spark, d)
    if tasks:
        met = salted_join(li, weeks.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"], "inner", salts=tasks,
                          tasks=tasks)
    else:
        met = li.join(weeks, F.col("l_orderkey") == F.col("o_orderkey"))
    weekly = met.select(F.col("_week").alias("fis_week_id"), F.col("l_partkey").alias("prod_group_code"))
    if tasks:
        weekly = weekly.repartition(tasks, "fis_week_id", "prod_group_code").distinct().repartition(tasks, "prod_group_code")
        p = p.repartition(tasks, "prod_group_code")
    else:
        weekly = weekly.distinct()
    return weekly.join(p, "prod_group_code").select(
        "fis_week_id", "prod_group_code", "brand_name", "prod_merch_l10_code", "prod_merch_l10_desc",
        "prod_desc")


def selected_nominations(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    wk = week_id("o_orderdate")
    return o.select(F.col("o_custkey").alias("parent_event_code"),
                    F.col("o_orderkey").alias("line_item_id"),
                    F.col("o_orderkey").alias("nomination_code"),
                    F.col("o_orderpriority").alias("seg_desc_list"),
                    wk.alias("nomination_start_week"),
                    wk.alias("event_start_week"))


def re_run_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("parent_event_code"),
        F.when(F.col("c_mktsegment") == "BUILDING", "true").otherwise("false").alias("re_run"))


# --------------------------------------------------------------------------- text tables
def corpus_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Documents with their quality label (null without one), the narrow document
    references, labels, pages with their title, conversation turns."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return {"documents": docs.join(labels, "doc_id", "left"), "document_refs": docs, "labels": labels,
            "pages": page_titles(spark, d), "turns": table(spark, d, "conversations").select("conv_id", "turn", "role")}


def page_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        "page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
