"""Every registered query runs on the driver's tables and matches its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tillroll.oracle import SQL
from tillroll.registry import QUERIES
from tillroll.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False))


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "customer_name", "total_spent"]
    assert df.count() >= 0


def test_every_key_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(SQL[name]).df()
    assert len(got) > 0
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", ["top_category_per_month", "top_category_per_month_reuse", "avg_order_value_by_month",
                                  "monthly_order_stats", "returned_orders_by_month"])
def test_monthly_results_are_in_order(spark, name):
    months = [r.month for r in QUERIES[name](spark, SF).collect()]
    assert months == sorted(months) and len(months) > 1


def test_details_have_rows_for_many_checks(spark):
    kinds = {r.check for r in QUERIES["validation_details"](spark, SF).select("check").distinct().collect()}
    assert len(kinds) >= 8
