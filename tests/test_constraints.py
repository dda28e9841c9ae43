"""Constraints compiled to checks, and the suite counted while its details are written."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tillroll.plans import constraints as C
from tillroll.plans import suite as SU
from tillroll.sources import catalog as IO

NOW = dt.datetime(2024, 5, 1)


def tables(spark):
    users = [(1, "ann", "a@x.y", None, NOW), (2, "bo", "a@x.y", None, NOW), (2, None, "c@x.y", None, None)]
    projects = [(10, "p", None, 1, NOW), (11, None, None, 9, NOW)]
    tasks = [(100, 10, "t", None, "todo", 3, 1, None, NOW), (101, 99, "t", None, "open", 6, None, None, NOW),
             (102, 10, "t", None, None, None, 7, None, NOW)]
    return {n: spark.createDataFrame(r, C.TRACKER[n]) for n, r in (("users", users), ("projects", projects), ("tasks", tasks))}


WANT = {
    ("users: required value missing", "id=2"), ("users.id: value not unique", "id=2"), ("users.email: value not unique", "id=1"),
    ("users.email: value not unique", "id=2"), ("projects: required value missing", "id=11"),
    ("projects.owner_id: no such users", "id=11"), ("tasks: required value missing", "id=102"),
    ("tasks.project_id: no such projects", "id=101"), ("tasks.status: value not allowed", "id=101"),
    ("tasks.priority: value out of bounds", "id=101"), ("tasks.assignee_id: no such users", "id=102")}


def test_the_trackers_constraints_give_its_suite(spark):
    checks = C.compile_checks(C.TRACKER, C.TRACKER_KEYS, {"unique": "warning"})
    assert len(checks) == 3 + 5 + 3 + 2
    assert {c.severity for c in checks if "unique" in c.name} == {"warning"}
    assert {(r.check, r.key) for r in SU.run_details(tables(spark), checks).collect()} == WANT


def test_rows_that_keep_all_constraints_are_not_reported(spark):
    t = tables(spark)
    clean = {"users": t["users"].limit(1), "projects": t["projects"].where("id = 10"), "tasks": t["tasks"].where("id = 100")}
    assert SU.run_details(clean, C.compile_checks(C.TRACKER, C.TRACKER_KEYS)).count() == 0
    assert SU.run_details({n: x.where("false") for n, x in t.items()}, C.compile_checks(C.TRACKER, C.TRACKER_KEYS)).count() == 0


def test_tables_are_created_with_their_defaults(spark):
    ddl, defaults = C.table_ddl(C.TRACKER["tasks"])
    IO.create_table(spark, "co_tasks", ddl, defaults, replace=True)
    spark.sql("INSERT INTO co_tasks (id, project_id, title) VALUES (1, 2, 't')")
    r = spark.table("co_tasks").first()
    assert (r.status, r.priority, r.assignee_id) == ("todo", 3, None)
    IO.drop_table(spark, "co_tasks")


def test_wrong_constraints_are_refused():
    with pytest.raises(ValueError):
        C.column("x", T.IntegerType(), requird=True)
    with pytest.raises(ValueError):
        C.column("x", T.IntegerType(), references="users")
    for target in ("nobody.id", "users.nothing", "users.username"):
        bad = {**C.TRACKER, "extra": T.StructType([C.column("x", T.LongType(), references=target)])}
        with pytest.raises(ValueError):
            C.compile_checks(bad, {**C.TRACKER_KEYS, "extra": ["x"]})


def test_the_summary_is_counted_while_details_are_written(spark):
    checks = C.compile_checks(C.TRACKER, C.TRACKER_KEYS)
    plans = []

    def store(found):
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return IO.overwrite(found, "co_details")
    stored, summary = SU.store_suite(tables(spark), checks, store)
    assert "CollectMetrics" in plans[0]
    want = SU.summarize_checks(tables(spark), checks)
    assert [tuple(r) for r in summary.collect()] == [tuple(r) for r in want.collect()]
    assert {(r.check, r.key) for r in stored.collect()} == WANT
    empty = {n: x.where("false") for n, x in tables(spark).items()}
    _, none = SU.store_suite(empty, checks, lambda d: IO.overwrite(d, "co_details"))
    assert {r.violations for r in none.collect()} == {0} and none.count() == len(checks)
    IO.drop_table(spark, "co_details")
