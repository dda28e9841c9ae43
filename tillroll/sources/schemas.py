"""Typed schemas of the logical tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("transaction_date", T.TimestampType(), True),
    T.StructField("payment_mode", T.StringType(), False),
    T.StructField("store_location", T.StringType(), False),
    T.StructField("discount_applied", T.BooleanType(), False),
    T.StructField("discount_amount", T.DoubleType(), False),
    T.StructField("loyalty_points_earned", T.IntegerType(), False),
    T.StructField("is_return", T.BooleanType(), False),
    T.StructField("sales_rep", T.StringType(), False),
])

SHOP_CUSTOMERS = "id int, email string, phone_number string"
SHOP_ORDERS = "id int, customer_id int, total_price decimal(10,2)"
SHOP_PRODUCTS = "id int, itemname string, item_colour string"
SHOP_ORDER_PRODUCTS = "order_id int, product_id int, quantity int"
CALENDAR = "calendar_date date, year int, month int, day int, weekday int, week int"

TRACKER_USERS = "id bigint, username string, email string, full_name string, created_at timestamp"
TRACKER_PROJECTS = "id bigint, name string, description string, owner_id bigint, created_at timestamp"
TRACKER_TASKS = ("id bigint, project_id bigint, title string, description string, status string, "
                 "priority smallint, assignee_id bigint, due_date date, created_at timestamp")

CUSTOMERS = "id bigint, name string, email string"
ORDERS = "id bigint, customer_id bigint, total_amount decimal(12,2), created_at timestamp"
ORDER_ITEMS = "id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)"
PRODUCTS = "id bigint, category_id bigint, name string"
CATEGORIES = "id bigint, name string"
RETURNS = "id bigint, order_id bigint, returned_at timestamp"

NOMINATION_PROD = ("fis_week_id int, event_type_code string, prod_level_code string, "
                   "nomination_code string, event_start_week int")
PROD = ("fis_week_id int, prod_group_code string, brand_name string, prod_merch_l10_code string, "
        "prod_merch_l10_desc string, prod_desc string")
SELECTED_NOMINATIONS = ("parent_event_code string, line_item_id int, nomination_code string, "
                        "seg_desc_list string, nomination_start_week int, event_start_week int")
RE_RUN_EVENTS = "parent_event_code string, re_run string"

# Table-level constraints of the tracker (enforced as validation checks, not
# by storage): allowed statuses, priority range, column defaults.
TRACKER_STATUSES = ("todo", "in_progress", "done", "blocked")
TRACKER_PRIORITY = (1, 5)
TRACKER_DEFAULTS = {"status": "todo", "priority": 3}
