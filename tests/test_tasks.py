"""Steps over large tables get tasks by their rows, with the same results."""

import random

import pytest

from tillroll.operators import quality as V
from tillroll.operators import skew
from tillroll.plans import nominations as N
from tillroll.registry import QUERIES
from tillroll.sources import adapters as A

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_grow_with_the_rows_and_small_tables_are_left_alone():
    assert [skew.tasks_for(n) for n in (0, 250_000, 1_000_000, 36_000_000, 216_000_000)] == [None, None, None, 144, 864]


@pytest.mark.parametrize("name", ["product_master", "constraint_violations", "constraint_summary", "validation_details",
                                  "validation_summary", "orphans"])
def test_queries_deal_large_tables_by_rows(spark, monkeypatch, name):
    want = QUERIES[name](spark, SF)
    assert "RepartitionByExpression" not in plan(want)
    monkeypatch.setattr(skew, "ROWS_EACH", 10)
    got = QUERIES[name](spark, SF)
    tasks = A.tasks_of(spark, SF, "documents" if name == "orphans" else "lineitem")
    assert tasks > 5 and f", {tasks}" in "".join(line for line in plan(got).splitlines() if "RepartitionByExpression" in line)


def test_violations_by_tasks(spark, monkeypatch):
    want = rows(QUERIES["constraint_violations"](spark, SF))
    monkeypatch.setattr(skew, "ROWS_EACH", 1000)          # few enough tasks to run here
    assert rows(QUERIES["constraint_violations"](spark, SF)) == want


def test_odd_keys_by_tasks(spark):
    """Null, repeated and hot keys; rows that repeat."""
    r = random.Random(3)
    key = [None if r.random() < 0.1 else 7 if r.random() < 0.4 else r.randint(0, 300) for _ in range(2000)]
    child = spark.createDataFrame([(i // 2, k) for i, k in enumerate(key)], "id long, fk long")
    child = child.union(child.limit(50))
    parent = spark.createDataFrame([(k, "x") for k in [*range(8, 250), *range(20, 40), None]], "pk long, x string")
    for ask in (lambda t: V.orphans(child, "fk", parent, "pk", keep=["id"], tasks=t),
                lambda t: V.orphans(child, "fk", parent, "pk", tasks=t),
                lambda t: V.duplicate_keys(child, ["fk"], "id", tasks=t),
                lambda t: V.duplicate_keys(child, "fk", None, tasks=t),
                lambda t: V.duplicate_keys(child, "fk", "id", hashed=True, tasks=t)):
        assert rows(ask(7)) == rows(ask(None)) and "RepartitionByExpression" in plan(ask(7))


def test_master_by_tasks(spark):
    assert rows(N.product_master(A.prod(spark, SF, 6))) == rows(N.product_master(A.prod(spark, SF)))
