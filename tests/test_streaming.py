"""Row-level checks and sales totals on a file stream (availableNow trigger)."""

from tillroll.plans import suite as SU
from tillroll.session import unique_name
from tillroll.sources import adapters as A
from tillroll.streaming import stream_row_checks, stream_sales_by_payment, write_batches

SF = "/root/testdata/sf0.001"


def test_row_checks_on_a_stream(spark, tmp_path):
    users = A.tracker_users(spark, SF)
    src = str(tmp_path / "users_in")
    users.write.parquet(src)
    stream = spark.readStream.schema(users.schema).parquet(src)
    checks = [SU.Check("users: balance out of range", "users", "range",
                       {"col": "balance", "lo": 0.0, "hi": 10000.0})]
    out = str(tmp_path / "violations")
    q = write_batches(stream_row_checks(stream, "users", checks), out, unique_name("t_row_checks"))
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = users.where("balance < 0 OR balance > 10000")
    assert got.count() == want.count() > 0


def test_sales_totals_on_a_stream(spark, tmp_path):
    sales = A.sales_transactions(spark, SF, ["amount", "quantity", "payment_mode"])
    src = str(tmp_path / "sales_in")
    sales.write.parquet(src)
    stream = spark.readStream.schema(sales.schema).parquet(src)
    out = str(tmp_path / "totals")
    q = write_batches(stream_sales_by_payment(stream), out, unique_name("t_sales_totals"), mode="complete")
    q.awaitTermination(120)
    from tillroll.plans.sales import sales_by_payment
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in sales_by_payment(sales).collect())
    assert got == want
