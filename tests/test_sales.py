"""Sales operators on the six-row fixture (golden values worked out by hand)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillroll.plans import sales as S
from tillroll.sources.schemas import SALES_SCHEMA


def _row(tid, cust, amount, qty, ts, mode):
    return (tid, cust, "n", "P", "p", "c", amount, qty, ts, mode, "NY", False, 0.0, 1, False, "SR01")


@pytest.fixture(scope="module")
def sample(spark):
    # The six-row test fixture.
    data = [
        _row("T001", "C1", 100.0, 1, datetime(2024, 6, 1, 10, 30), "Credit Card"),
        _row("T002", "C1", 50.0, 2, datetime(2024, 6, 2, 14, 15), "Debit Card"),
        _row("T003", "C2", 20.0, 1, datetime(2024, 6, 3, 9, 45), "Debit Card"),
        _row("T004", "C3", 9.0, 1, datetime(2024, 6, 4, 11, 0), "Credit Card"),
        _row("T005", "C3", 90.0, 1, datetime(2024, 6, 4, 12, 0), "Debit Card"),
        _row("T006", "C4", 15.0, 1, None, "Cash"),
    ]
    return spark.createDataFrame(data, SALES_SCHEMA)


@pytest.fixture(scope="module")
def seed_rows(spark):
    # The notebook's five seed rows (relevant columns).
    data = [
        _row("T001", "C001", 1200.0, 1, datetime(2024, 6, 1, 10, 30), "Credit Card"),
        _row("T002", "C002", 60.0, 2, datetime(2024, 6, 2, 14, 15), "Cash"),
        _row("T003", "C003", 15.0, 5, datetime(2024, 6, 3, 9, 45), "PayPal"),
        _row("T004", "C004", 85.0, 1, datetime(2024, 6, 4, 16, 0), "Gift Card"),
        _row("T005", "C005", 120.0, 1, datetime(2024, 6, 5, 11, 20), "Credit Card"),
    ]
    return spark.createDataFrame(data, SALES_SCHEMA)


def test_clean_drops_null_rows_and_adds_year(sample):
    clean = S.clean_sales(sample)
    assert sample.count() == 6
    assert clean.count() == 5
    assert [r.order_year for r in clean.select("order_year").distinct().collect()] == [2024]


def test_clean_filter_reaches_the_scan(spark, tmp_path, sample):
    path = str(tmp_path / "sales")
    sample.write.parquet(path)
    plan = S.clean_sales(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(transaction_id)" in plan


def test_total_sales_per_year(sample):
    out = S.sales_by_year(S.clean_sales(sample)).collect()
    assert [(r.order_year, r.total_sales, r.transactions) for r in out] == [(2024, 319.0, 5)]


def test_total_per_payment_mode(sample):
    out = {r.payment_mode: r.total_amount for r in S.sales_by_payment(S.clean_sales(sample)).collect()}
    assert out == {"Credit Card": 109.0, "Debit Card": 210.0}


def test_sales_by_year_falls_back_to_the_date(sample):
    out = S.sales_by_year(sample.where(F.col("transaction_date").isNotNull())).collect()
    assert out[0].total_sales == 319.0


def test_credit_debit_violations_after_cleaning(sample):
    out = S.credit_debit_violations(S.clean_sales(sample)).collect()
    assert [r.customer_id for r in out] == ["C1"]
    r = out[0]
    assert (r.total_credit, r.total_debit, r.total_amount, r.credit_pct) == (100.0, 100.0, 200.0, 0.5)
    assert r.credit_lt_debit is False and r.credit_le_10pct is False


def test_customer_without_credit_or_debit_is_a_violation(sample):
    out = S.credit_debit_violations(sample).collect()
    assert sorted(r.customer_id for r in out) == ["C1", "C4"]
    c4 = [r for r in out if r.customer_id == "C4"][0]
    assert c4.credit_pct == 0.0 and c4.credit_lt_debit is False


def test_negative_transactions(spark, sample):
    neg = spark.createDataFrame([_row("T007", "C5", -5.0, 2, datetime(2024, 6, 5), "Cash")], SALES_SCHEMA)
    out = S.negative_transactions(sample.unionByName(neg)).collect()
    assert [(r.transaction_id, r.total_amount) for r in out] == [("T007", -10.0)]
    assert S.negative_transactions(sample).count() == 0


def test_notebook_seed_rows(seed_rows):
    assert S.sales_by_year(seed_rows).collect()[0].total_sales == 1600.0
    out = {r.payment_mode: r.total_amount for r in S.sales_by_payment(seed_rows).collect()}
    assert out == {"Credit Card": 1320.0, "Cash": 120.0, "Gift Card": 85.0, "PayPal": 75.0}
    assert [r.payment_mode for r in S.sales_by_payment(seed_rows).collect()][0] == "Credit Card"


def test_sign_is_tested_before_any_rounding(spark):
    """Amounts below half a cent keep their sign, and sums keep them."""
    from tillroll.plans.sales import negative_transactions, sales_by_payment
    rows = [("T1", "C1", None, -0.004, 1, "Cash", "x"), ("T2", "C1", None, -1.0, 1, "Cash", "x"),
            ("T3", "C1", None, -1.0, -1, "Cash", "x"), ("T4", "C1", None, 0.0, -1, "Cash", "x"),
            ("T5", "C1", None, 2.0, -3, "Cash", "x"), ("T6", None, None, None, 1, "Cash", "x")]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_date timestamp, amount double, "
                                     "quantity int, payment_mode string, store_location string")
    out = {r.transaction_id: r.total_amount for r in negative_transactions(df).collect()}
    assert out == {"T1": -0.004, "T2": -1.0, "T5": -6.0}
    assert sales_by_payment(df).first().total_amount == -6.004
