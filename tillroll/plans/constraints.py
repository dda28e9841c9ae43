"""Table constraints compiled to checks.

A constraint stands in a column's metadata, beside its type: ``required``,
``unique``, ``references`` ("table.column"), ``allowed`` (values), ``between``
(two bounds), ``pattern`` (regular expression), ``default``.  Parquet tables
don't enforce any of them; ``compile_checks`` turns a set of such schemas into
the list of checks that finds the rows which break them, and ``table_ddl`` into
columns with their defaults for ``catalog.create_table``.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import types as T

from tillroll.plans.suite import Check

RULES = ("required", "unique", "references", "allowed", "between", "pattern", "default")


def column(name: str, kind: str, **rules) -> T.StructField:
    """A column with its constraints: ``column("status", T.StringType(), required=True, allowed=[...])``."""
    unknown = sorted(set(rules) - set(RULES))
    if unknown:
        raise ValueError(f"column {name}: unknown constraints {unknown}")
    if "references" in rules and rules["references"].count(".") != 1:
        raise ValueError(f"column {name}: references needs 'table.column', not {rules['references']!r}")
    return T.StructField(name, kind, True, {k: list(v) if isinstance(v, tuple) else v for k, v in rules.items()})


def compile_checks(tables: Mapping[str, T.StructType], keys: Mapping[str, list[str]],
                   severity: Mapping[str, str] | None = None) -> list[Check]:
    """The checks that the schemas' constraints ask for, table by table in column order.

    ``keys`` names the columns that identify a table's rows in the report;
    ``severity`` maps rules to severities (default ``error``).  A null value
    breaks ``required`` only, as in SQL.  Tables and columns that a reference
    names have to exist, with a type that can be compared."""
    severity, out = severity or {}, []
    for table, schema in tables.items():
        key = tuple(keys[table])
        required = [f.name for f in schema.fields if f.metadata.get("required")]
        if required:
            out.append(Check(f"{table}: required value missing", table, "missing", {"not_null": required},
                             severity.get("required", "error"), key, tuple(required)))
        for f in schema.fields:
            for rule in RULES[1:-1]:
                if rule in f.metadata:
                    out.append(_check(tables, table, f, rule, key, severity.get(rule, "error")))
    return out


def _check(tables, table: str, f: T.StructField, rule: str, key: tuple, severity: str) -> Check:
    want, name = f.metadata[rule], f"{table}.{f.name}"
    if rule == "unique":
        return Check(f"{name}: value not unique", table, "duplicates",
                     {"col": f.name, **({"id": key[0]} if len(key) == 1 and key[0] != f.name else {})}, severity, key)
    if rule == "references":
        parent, pk = want.split(".")
        if parent not in tables or pk not in tables[parent].names:
            raise ValueError(f"{name} references {want}, which isn't there")
        if tables[parent][pk].dataType != f.dataType:
            raise ValueError(f"{name} and {want} have different types")
        return Check(f"{name}: no such {parent}", table, "orphans", {"fk": f.name, "parent": parent, "pk": pk}, severity, key)
    if rule == "allowed":
        return Check(f"{name}: value not allowed", table, "in_set", {"col": f.name, "values": list(want)}, severity, key)
    if rule == "between":
        lo, hi = want
        return Check(f"{name}: value out of bounds", table, "range", {"col": f.name, "lo": lo, "hi": hi}, severity, key)
    return Check(f"{name}: value of another form", table, "pattern", {"col": f.name, "regex": want}, severity, key)


def table_ddl(schema: T.StructType) -> tuple[str, dict]:
    """(column list, defaults) for ``catalog.create_table``."""
    return (", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields),
            {f.name: f.metadata["default"] for f in schema.fields if "default" in f.metadata})


#: The tracker's tables with their constraints (fixed values: allowed states and priorities, defaults).
TRACKER = {
    "users": T.StructType([
        column("id", T.LongType(), required=True, unique=True),
        column("username", T.StringType(), required=True, unique=True),
        column("email", T.StringType(), required=True, unique=True),
        column("full_name", T.StringType()),
        column("created_at", T.TimestampType(), required=True)]),
    "projects": T.StructType([
        column("id", T.LongType(), required=True, unique=True),
        column("name", T.StringType(), required=True),
        column("description", T.StringType()),
        column("owner_id", T.LongType(), required=True, references="users.id"),
        column("created_at", T.TimestampType(), required=True)]),
    "tasks": T.StructType([
        column("id", T.LongType(), required=True, unique=True),
        column("project_id", T.LongType(), required=True, references="projects.id"),
        column("title", T.StringType(), required=True),
        column("description", T.StringType()),
        column("status", T.StringType(), required=True, default="todo", allowed=["todo", "in_progress", "done", "blocked"]),
        column("priority", T.ShortType(), required=True, default=3, between=[1, 5]),
        column("assignee_id", T.LongType(), references="users.id"),
        column("due_date", T.DateType()),
        column("created_at", T.TimestampType(), required=True)]),
}
TRACKER_KEYS = {"users": ["id"], "projects": ["id"], "tasks": ["id"]}
