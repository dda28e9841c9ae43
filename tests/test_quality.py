"""Data-quality operators on a tracker fixture with one planted violation per check."""

from datetime import date, datetime

import pytest

from tillroll.operators import quality as V
from tillroll.plans import suite as SU

AS_OF = "2024-06-01 00:00:00"


@pytest.fixture(scope="module")
def tracker(spark):
    users = spark.createDataFrame([
        (1, "alice", "alice@example.com", datetime(2024, 1, 1)),
        (2, " bob ", "bob@example.com", datetime(2024, 1, 2)),        # untrimmed
        (3, "", "carol@example.com", datetime(2024, 1, 3)),           # blank username
        (4, "dave", "bad@mail", datetime(2024, 1, 4)),                # bad email
        (5, "eve", "dup@example.com", datetime(2024, 1, 5)),
        (6, "frank", "dup@example.com", datetime(2030, 1, 1)),        # duplicate email, future
        (7, None, None, datetime(2024, 1, 7)),                        # missing username and email
    ], "id bigint, username string, email string, created_at timestamp")
    projects = spark.createDataFrame([
        (10, "p10", 1, datetime(2024, 2, 1)), (11, "p11", 9999, datetime(2024, 2, 2)),   # orphan owner
        (12, "p12", 2, datetime(2024, 2, 3)), (13, "p13", 3, datetime(2024, 2, 4)),     # 13 has no tasks
    ], "id bigint, name string, owner_id bigint, created_at timestamp")
    tasks = spark.createDataFrame([
        (100, 10, "t", "todo", 3, 1, date(2024, 3, 1), datetime(2024, 2, 10)),           # assignee = owner
        (101, 11, "t", "open", 0, 2, date(2024, 1, 1), datetime(2024, 2, 10)),            # status, range, due<created
        (102, 12, "t", "done", 6, 9999, None, datetime(2024, 2, 10)),                     # range, orphan assignee
        (103, 9999, "t", "todo", None, None, None, datetime(2024, 2, 10)),                # orphan project, null prio
    ], "id bigint, project_id bigint, title string, status string, priority int, assignee_id bigint, "
       "due_date date, created_at timestamp")
    return {"users": users, "projects": projects, "tasks": tasks}


def ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_missing_required(tracker):
    out = V.missing_required(tracker["users"], not_null=["username", "email"],
                             not_blank=["username", "email"], keep=["id"])
    assert ids(out) == [3, 7]
    assert out.columns == ["check", "id"]


def test_duplicate_keys_long_form(tracker):
    out = V.duplicate_keys(tracker["users"], "email", "id", check="dup email")
    assert sorted((r.email, r.id, r.cnt) for r in out.collect()) == \
        [("dup@example.com", 5, 2), ("dup@example.com", 6, 2)]
    hashed = V.duplicate_keys(tracker["users"], "email", "id", check="dup email", hashed=True)
    assert sorted(tuple(r) for r in hashed.collect()) == sorted(tuple(r) for r in out.collect())
    per_key = V.duplicate_keys(tracker["users"], ["email"], None)
    assert [(r.email, r.cnt) for r in per_key.collect()] == [("dup@example.com", 2)]


def test_duplicate_keys_ignores_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    assert V.duplicate_keys(df, "k", "id").count() == 0


def test_pattern_and_whitespace(tracker):
    users = tracker["users"]
    assert ids(V.pattern_violation(users, "email", r"^[^@\s]+@[^@\s]+\.[^@\s]+$")) == [4]
    assert ids(V.whitespace_violation(users, "username")) == [2, 3]


def test_set_and_range_never_report_null(tracker):
    tasks = tracker["tasks"]
    assert ids(V.not_in_set(tasks, "status", ["todo", "in_progress", "done", "blocked"])) == [101]
    assert ids(V.out_of_range(tasks, "priority", 1, 5)) == [101, 102]


def test_orphans_and_childless(tracker):
    users, projects, tasks = tracker["users"], tracker["projects"], tracker["tasks"]
    assert ids(V.orphans(projects, "owner_id", users, "id", keep=["id"])) == [11]
    assert ids(V.orphans(tasks, "project_id", projects, "id", keep=["id"])) == [103]
    assert ids(V.orphans(tasks, "assignee_id", users, "id", keep=["id"])) == [102]
    assert ids(V.childless(projects, "id", tasks, "project_id", keep=["id"])) == [13]


def test_temporal(tracker):
    users, tasks = tracker["users"], tracker["tasks"]
    assert ids(V.future_timestamps(users, "created_at", AS_OF)) == [6]
    assert ids(V.future_timestamps(users, "created_at", datetime(2024, 1, 4, 12))) == [5, 6, 7]
    from pyspark.sql import functions as F
    assert ids(V.precedes(tasks, F.col("created_at").cast("date"), "due_date")) == [101]


def test_matching_parent_attr(tracker):
    out = V.matching_parent_attr(tracker["tasks"], "project_id", tracker["projects"], "id",
                                 "assignee_id", "owner_id", keep=["id", "assignee_id", "owner_id"])
    assert [tuple(r) for r in out.collect()] == [(out.first().check, 100, 1, 1)]


def test_row_counts(tracker):
    out = V.row_counts(tracker)
    assert sorted(tuple(r) for r in out.collect()) == [("counts: projects", 4), ("counts: tasks", 4),
                                                       ("counts: users", 7)]


def _spec():
    return [
        SU.Check("users: missing", "users", "missing", {"not_blank": ["username", "email"]}),
        SU.Check("users: duplicate emails", "users", "duplicates", {"col": "email", "id": "id"}),
        SU.Check("users: email format", "users", "pattern",
                 {"col": "email", "regex": r"^[^@\s]+@[^@\s]+\.[^@\s]+$"}),
        SU.Check("users: whitespace", "users", "whitespace", {"col": "username"}),
        SU.Check("tasks: status", "tasks", "in_set", {"col": "status",
                                                      "values": ["todo", "in_progress", "done", "blocked"]}),
        SU.Check("tasks: priority", "tasks", "range", {"col": "priority", "lo": 1, "hi": 5}),
        SU.Check("projects: owner orphan", "projects", "orphans", {"fk": "owner_id", "parent": "users", "pk": "id"}),
        SU.Check("tasks: project orphan", "tasks", "orphans", {"fk": "project_id", "parent": "projects", "pk": "id"}),
        SU.Check("users: future", "users", "future", {"col": "created_at"}),
        SU.Check("tasks: due before created", "tasks", "precedes",
                 {"first": "created_at", "later": "due_date", "first_as_date": True}),
        SU.Check("projects: no tasks", "projects", "childless", {"pk": "id", "child": "tasks", "fk": "project_id"},
                 severity="warning"),
        SU.Check("tasks: assignee is owner", "tasks", "same_as_parent",
                 {"fk": "project_id", "parent": "projects", "pk": "id", "attr": "assignee_id",
                  "parent_attr": "owner_id"}, severity="review"),
    ]


def test_suite_summary_and_details(tracker):
    details, summary = SU.run_suite(tracker, _spec(), as_of=AS_OF)
    got = [(r.check, r.severity, r.violations) for r in summary.collect()]
    assert got == [
        ("users: missing", "error", 2), ("users: duplicate emails", "error", 2),
        ("users: email format", "error", 1), ("users: whitespace", "error", 2),
        ("tasks: status", "error", 1), ("tasks: priority", "error", 2),
        ("projects: owner orphan", "error", 1), ("tasks: project orphan", "error", 1),
        ("users: future", "error", 1), ("tasks: due before created", "error", 1),
        ("projects: no tasks", "warning", 1), ("tasks: assignee is owner", "review", 1),
    ]
    assert details.columns == ["check", "severity", "entity", "key", "details"]
    rows = {(r.check, r.key) for r in details.collect()}
    assert ("users: email format", "id=4") in rows and ("tasks: priority", "id=102") in rows


def test_suite_row_checks_scan_each_table_once(tracker):
    spec = [c for c in _spec() if c.kind in SU.ROW_KINDS and c.table == "users"]
    details = SU.run_details(tracker, spec, as_of=AS_OF)
    text = details._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") == 1      # one scan of the users rows for four checks


def test_anti_joins_in_plans(tracker):
    orphans = V.orphans(tracker["tasks"], "project_id", tracker["projects"], "id", keep=["id"])
    childless = V.childless(tracker["projects"], "id", tracker["tasks"], "project_id", keep=["id"])
    for df in (orphans, childless):
        assert "LeftAnti" in df._jdf.queryExecution().optimizedPlan().toString()


def test_skewed_references(spark):
    # one parent holds most references; results stay whole and exact
    parents = spark.range(0, 50).withColumnRenamed("id", "pid")
    children = spark.range(0, 20000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 40 ELSE 7 END AS pid")
    assert V.childless(parents, "pid", children, "pid", keep=["pid"]).count() == 10
    dup = V.duplicate_keys(children, ["pid"], "id")
    assert dup.count() == 20000


def test_summary_from_details_equals_direct_counts(tracker):
    details, summary = SU.run_suite(tracker, _spec(), as_of=AS_OF)
    assert [tuple(r) for r in SU.summarize(details, _spec()).collect()] == [tuple(r) for r in summary.collect()]


def test_bad_specs_are_refused(spark):
    df = spark.createDataFrame([(1, 7)], "id int, v int")
    typo = [SU.Check("a", "t", "rnage", {"col": "v", "lo": 0, "hi": 1})]
    twice = [SU.Check("a", "t", "range", {"col": "v", "lo": 0, "hi": 1})] * 2
    for checks in (typo, twice):
        for run in (SU.run_details, SU.summarize_checks):
            with pytest.raises(ValueError):
                run({"t": df}, checks)


def test_each_check_reports_its_own_entity(spark):
    df = spark.createDataFrame([(1, 7)], "id int, v int")
    checks = [SU.Check("a", "t", "range", {"col": "v", "lo": 0, "hi": 1}, entity="first"),
              SU.Check("b", "t", "range", {"col": "v", "lo": 0, "hi": 2}, entity="second"),
              SU.Check("c", "t", "range", {"col": "v", "lo": 0, "hi": 3})]
    got = {r.check: r.entity for r in SU.run_details({"t": df}, checks).collect()}
    assert got == {"a": "first", "b": "second", "c": "t"}


def test_the_parents_value_is_reported(spark):
    child = spark.createDataFrame([(1, 10, 5, 99)], "id int, fk int, a int, owner int")
    parent = spark.createDataFrame([(10, 5)], "pk int, owner int")
    r = V.matching_parent_attr(child, "fk", parent, "pk", "a", "owner", keep=["id", "a", "owner"]).first()
    assert (r.a, r.owner) == (5, 5)
