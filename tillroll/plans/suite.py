"""Declarative validation suite.

``run_suite(tables, checks)`` returns two frames:

* details: ``check, severity, entity, key, details`` - one row per violation;
* summary: ``check, severity, violations`` - one row per check, zeros included.

Row-level checks on the same table are evaluated in ONE scan: each row yields
the array of the checks it fails, which is exploded (rows failing nothing
produce nothing).  Relational checks (duplicates, orphans, childless parents,
parent-attribute matches) are joins, each planned by Catalyst/AQE.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions.predicates import any_of
from tillroll.operators import quality as V
from tillroll.operators.relational import union_all

ROW_KINDS = ("missing", "pattern", "whitespace", "in_set", "range", "future", "precedes")
REL_KINDS = ("duplicates", "orphans", "childless", "same_as_parent")


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str
    params: Mapping = field(default_factory=dict)
    severity: str = "error"
    key: Sequence[str] = ("id",)
    show: Sequence[str] = ()          # columns rendered into ``details``
    entity: str | None = None         # reported entity (default: ``table``)

    @property
    def label(self) -> str:
        return self.entity or self.table


def _checked(checks: Sequence[Check]) -> Sequence[Check]:
    """The checks, if every kind is known and every name stands once."""
    unknown = sorted({c.kind for c in checks} - set(ROW_KINDS) - set(REL_KINDS))
    if unknown:
        raise ValueError(f"unknown check kinds: {unknown}")
    names = [c.name for c in checks]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"check names used more than once: {twice}")
    return checks


def _condition(df: DataFrame, c: Check, as_of) -> Column:
    p = c.params
    if c.kind == "missing":
        return V.missing_condition(p.get("not_null", ()), p.get("not_blank", ()))
    if c.kind == "pattern":
        return V.pattern_condition(p["col"], p["regex"])
    if c.kind == "whitespace":
        return V.whitespace_condition(p["col"])
    if c.kind == "in_set":
        return V.not_in_set_condition(p["col"], p["values"])
    if c.kind == "range":
        return V.out_of_range_condition(p["col"], p["lo"], p["hi"])
    if c.kind == "future":
        return V.future_condition(df, p["col"], p.get("as_of", as_of))
    if c.kind == "precedes":
        first = F.col(p["first"])
        if p.get("first_as_date"):
            first = first.cast("date")
        return V.precedes_condition(first, F.col(p["later"]))
    raise ValueError(f"not a row-level check kind: {c.kind}")


def _text(cols: Sequence[str]) -> Column:
    if not cols:
        return F.lit("")
    return F.concat_ws(", ", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
                               for c in cols])


def _out(df: DataFrame, check: Check, entity: str, key: Sequence[str], show: Sequence[str]) -> DataFrame:
    return df.select(F.lit(check.name).alias("check"), F.lit(check.severity).alias("severity"),
                     F.lit(entity).alias("entity"), _text(key).alias("key"), _text(show).alias("details"))


def _row_level(df: DataFrame, checks: Sequence[Check], as_of) -> DataFrame:
    """All row-level checks of one table in one pass over it.

    Rows failing at least one check are kept first (one OR of the conditions,
    evaluated in generated code and pushable to the scan); only those rows are
    exploded into one row per failed check."""
    conds = [_condition(df, c, as_of) for c in checks]
    flags = F.array(*[F.when(cond, F.lit(i)) for i, cond in enumerate(conds)])
    hits = (df.where(any_of(conds)).withColumn("_i", F.explode(flags))
            .where(F.col("_i").isNotNull()))
    name = severity = entity = key = details = None
    for i, c in enumerate(checks):
        hit = F.col("_i") == i
        show = c.show or [c.params[k] for k in ("col", "first", "later") if k in c.params]
        vals = [(name, F.lit(c.name)), (severity, F.lit(c.severity)), (entity, F.lit(c.label)),
                (key, _text(c.key)), (details, _text(show))]
        if name is None:
            name, severity, entity, key, details = [F.when(hit, v) for _, v in vals]
        else:
            name, severity, entity, key, details = [acc.when(hit, v) for acc, v in vals]
    return hits.select(name.alias("check"), severity.alias("severity"), entity.alias("entity"),
                       key.alias("key"), details.alias("details"))


def _uniq(cols) -> list:
    return list(dict.fromkeys(cols))


def _relational_rows(tables: Mapping[str, DataFrame], c: Check, tasks: Mapping[str, int | None] | None = None):
    """(offending rows, key columns, detail columns) of a relational check.

    ``tasks`` names the tasks that a table's rows are dealt to (``skew.tasks_for``)."""
    p, df, tasks = c.params, tables[c.table], tasks or {}
    if c.kind == "duplicates":
        cols = [p["col"]] if isinstance(p["col"], str) else list(p["col"])
        out = V.duplicate_keys(df, cols, p.get("id"), c.name, hashed=p.get("hashed", False),
                               tasks=tasks.get(c.table))
        return out, ([p.get("id")] if p.get("id") else cols), cols + ["cnt"]
    if c.kind == "orphans":
        out = V.orphans(df, p["fk"], tables[p["parent"]], p["pk"], keep=_uniq(list(c.key) + [p["fk"]]),
                        check=c.name, tasks=max((tasks.get(t) or 0 for t in (c.table, p["parent"]))) or None)
        return out, c.key, [p["fk"]]
    if c.kind == "childless":
        out = V.childless(df, p["pk"], tables[p["child"]], p["fk"], keep=_uniq(list(c.key) + list(c.show)),
                          check=c.name)
        return out, c.key, c.show
    if c.kind == "same_as_parent":
        out = V.matching_parent_attr(df, p["fk"], tables[p["parent"]], p["pk"], p["attr"],
                                     p["parent_attr"], keep=_uniq(list(c.key) + [p["attr"], p["fk"]]),
                                     check=c.name)
        return out, c.key, [p["attr"], p["fk"]]
    raise ValueError(f"unknown check kind: {c.kind}")


def _relational(tables: Mapping[str, DataFrame], c: Check, tasks: Mapping[str, int | None] | None = None) -> DataFrame:
    out, key, show = _relational_rows(tables, c, tasks)
    return _out(out, c, c.label, key, show)


def run_details(tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of=None,
                tasks: Mapping[str, int | None] | None = None) -> DataFrame:
    """One row per violation; ``tasks`` (table -> tasks, see ``skew.tasks_for``) bounds the rows of a task of the
    duplicate and orphan checks on large tables."""
    parts = []
    by_table: dict[str, list[Check]] = {}
    for c in _checked(checks):
        if c.kind in ROW_KINDS:
            by_table.setdefault(c.table, []).append(c)
    for t, cs in by_table.items():
        parts.append(_row_level(tables[t], cs, as_of))
    for c in checks:
        if c.kind in REL_KINDS:
            parts.append(_relational(tables, c, tasks))
    return union_all(parts)


def summarize(details: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Violations per check; checks without violations report 0.  The list of
    checks is the (tiny) spec itself, so it is broadcast."""
    spark = details.sparkSession
    spec = spark.createDataFrame([(c.name, c.severity, i) for i, c in enumerate(checks)],
                                 "check string, severity string, _ord int")
    counts = details.groupBy("check").agg(F.count(F.lit(1)).alias("violations"))
    return (F.broadcast(spec).join(counts, "check", "left")
            .select("check", "severity", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
                    "_ord")
            .orderBy("_ord").drop("_ord"))


def _row_level_counts(df: DataFrame, checks: Sequence[Check], as_of) -> DataFrame:
    """Violation counts of all row-level checks of one table: a single scan
    and one global aggregate (partial counts per task), then unpivoted."""
    one = df.agg(*[F.count(F.when(_condition(df, c, as_of), F.lit(1))).alias(f"_{i}")
                   for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"_{i}").alias("violations"))
                     for i, c in enumerate(checks)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def summarize_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of=None,
                     tasks: Mapping[str, int | None] | None = None) -> DataFrame:
    """The summary computed directly (no per-violation rows are built); ``tasks`` as in ``run_details``."""
    parts = []
    by_table: dict[str, list[Check]] = {}
    for c in _checked(checks):
        if c.kind in ROW_KINDS:
            by_table.setdefault(c.table, []).append(c)
    for t, cs in by_table.items():
        parts.append(_row_level_counts(tables[t], cs, as_of))
    for c in checks:
        if c.kind in REL_KINDS:
            parts.append(_relational_rows(tables, c, tasks)[0].agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(c.name).alias("check"), "violations"))
    counts = union_all(parts)
    spark = counts.sparkSession
    spec = spark.createDataFrame([(c.name, c.severity, i) for i, c in enumerate(checks)],
                                 "check string, severity string, _ord int")
    return (F.broadcast(spec).join(counts, "check", "left")
            .select("check", "severity", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
                    "_ord")
            .orderBy("_ord").drop("_ord"))


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of=None):
    """(details, summary).  Both are lazy and independent: acting on the
    summary does not build the per-violation rows."""
    return run_details(tables, checks, as_of), summarize_checks(tables, checks, as_of)


def store_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], store, as_of=None,
                tasks: Mapping[str, int | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """(stored details, summary) in one pass: the violations are counted while the details are written.

    ``store`` takes the details and returns the stored frame, e.g.
    ``lambda d: catalog.overwrite(d, "violations")``; it has to act on them once.
    The counts are observed metrics of that one action (one number a check), so
    the tables are read once, where ``run_suite`` reads them for either frame."""
    seen = Observation("violations")
    counts = [F.count_if(F.col("check") == c.name).alias(f"check_{i}") for i, c in enumerate(checks)]
    stored = store(run_details(tables, checks, as_of, tasks).observe(seen, *counts))
    found = seen.get
    rows = [(c.name, c.severity, int(found[f"check_{i}"])) for i, c in enumerate(checks)]
    summary = stored.sparkSession.createDataFrame(rows, "check string, severity string, violations long")
    return stored, summary


# ----------------------------------------------------------------------------- tracker spec
def tracker_checks(as_of, statuses, username_regex=r"^Customer#[0-9]+$",
                   balance=(0.0, 10000.0)) -> list[Check]:
    """The project-tracker suite: users / projects / tasks.

    ``tasks`` carries the project's date and priority (a join); ``task_refs``
    is the narrow task table the relational checks need, so they do not
    repeat that join."""
    task = dict(key=("project_id", "line"))
    refs = dict(key=("project_id", "line"), entity="tasks")
    return [
        Check("user without name or segment", "users", "missing",
              {"not_null": ["id"], "not_blank": ["username", "segment"]}, show=["username", "segment"]),
        Check("project without owner or status", "projects", "missing",
              {"not_null": ["owner_id"], "not_blank": ["status"]}, show=["owner_id", "status"]),
        Check("task with a required value missing", "tasks", "missing",
              {"not_null": ["project_id", "priority"], "not_blank": ["status"]}, show=["status", "priority"], **task),
        Check("user name taken twice", "users", "duplicates", {"col": "username", "id": "id"}),
        Check("user name of another form", "users", "pattern", {"col": "username", "regex": username_regex}),
        Check("user name with outer blanks", "users", "whitespace", {"col": "username"}),
        Check("user balance beyond its limits", "users", "range",
              {"col": "balance", "lo": balance[0], "hi": balance[1]}),
        Check("project status not on the list", "projects", "in_set", {"col": "status", "values": list(statuses)}),
        Check("task priority beyond 1 to 5", "tasks", "range", {"col": "priority", "lo": 1, "hi": 5}, **task),
        Check("project owner unknown", "projects", "orphans", {"fk": "owner_id", "parent": "users", "pk": "id"}),
        Check("task of an unknown project", "task_refs", "orphans",
              {"fk": "project_id", "parent": "projects", "pk": "id"}, **refs),
        Check("task assignee unknown", "task_refs", "orphans",
              {"fk": "assignee_id", "parent": "users", "pk": "id"}, **refs),
        Check("user dated ahead", "users", "future", {"col": "created_at", "as_of": as_of}),
        Check("project dated ahead", "projects", "future", {"col": "created_at", "as_of": as_of}),
        Check("task dated ahead", "tasks", "future", {"col": "created_at", "as_of": as_of}, **task),
        Check("task due before its creation", "tasks", "precedes",
              {"first": "created_at", "later": "due_date", "first_as_date": True}, **task),
        Check("project without tasks", "projects", "childless",
              {"pk": "id", "child": "task_refs", "fk": "project_id"}, severity="warning", show=("owner_id",)),
        Check("task assigned to the project's owner", "task_refs", "same_as_parent",
              {"fk": "project_id", "parent": "projects", "pk": "id", "attr": "assignee_id",
               "parent_attr": "owner_id"}, severity="review", **refs),
    ]


def corpus_checks(url_regex: str, roles) -> list[Check]:
    """Checks of the text tables: documents with their labels, pages with their titles, conversation turns."""
    return [
        Check("document without a quality label", "documents", "missing", {"not_null": ["quality"]}, key=("doc_id",),
              show=("source",)),
        Check("document that nobody labelled", "document_refs", "orphans",
              {"fk": "doc_id", "parent": "labels", "pk": "doc_id"}, key=("doc_id",), entity="documents"),
        Check("page url of another form", "pages", "pattern", {"col": "url", "regex": url_regex}, key=("page_id",)),
        Check("page title with outer blanks", "pages", "whitespace", {"col": "title"}, key=("page_id",),
              show=("url",)),
        Check("turn role not on the list", "turns", "in_set", {"col": "role", "values": list(roles)},
              key=("conv_id", "turn")),
    ]
