"""Data-quality operators.  Each returns ``check`` plus the offending rows.

Row-level checks are predicates (``*_condition``) so the suite can evaluate all
of a table's checks in one scan; relational checks are joins.  A NULL value is
reported only by the missing-value check: every other predicate guards NULL
explicitly, so three-valued logic never silently drops or adds a row.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.predicates import any_of, is_blank, untrimmed
from tillroll.operators.relational import anti


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _report(df: DataFrame, check: str, cond: Column, keep: Sequence) -> DataFrame:
    return df.where(cond).select(F.lit(check).alias("check"), *[_c(k) for k in keep])


# --------------------------------------------------------------------------- row conditions
def missing_condition(not_null: Iterable[str] = (), not_blank: Iterable[str] = ()) -> Column:
    conds = [F.col(c).isNull() for c in not_null]
    conds += [F.col(c).isNull() | is_blank(c) for c in not_blank]
    return any_of(conds)


def pattern_condition(col: str, regex: str) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).rlike(regex)


def whitespace_condition(col: str) -> Column:
    return F.col(col).isNotNull() & (untrimmed(col) | is_blank(col))


def not_in_set_condition(col: str, values: Iterable) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def out_of_range_condition(col: str, lo, hi) -> Column:
    return F.col(col).isNotNull() & ((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def _as_of(df: DataFrame, col: str, as_of) -> Column:
    """The reference point, typed like the column (so a timestamp_ntz column is
    compared with a zone-free literal).  None means now()."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.lit(str(as_of)).cast(df.schema[col].dataType)


def future_condition(df: DataFrame, col: str, as_of=None) -> Column:
    return F.col(col).isNotNull() & (F.col(col) > _as_of(df, col, as_of))


def precedes_condition(expected_first, expected_later) -> Column:
    """Violation when the value expected later is strictly before the first."""
    a, b = _c(expected_first), _c(expected_later)
    return a.isNotNull() & b.isNotNull() & (b < a)


# --------------------------------------------------------------------------- V1 .. V6, V8, V9
def missing_required(df: DataFrame, not_null: Iterable[str] = (), not_blank: Iterable[str] = (),
                     keep: Sequence = (), check: str = "missing required values") -> DataFrame:
    return _report(df, check, missing_condition(not_null, not_blank), keep or df.columns)


def pattern_violation(df: DataFrame, col: str, regex: str, keep: Sequence = (),
                      check: str = "invalid format") -> DataFrame:
    return _report(df, check, pattern_condition(col, regex), keep or df.columns)


def whitespace_violation(df: DataFrame, col: str, keep: Sequence = (),
                         check: str = "whitespace issues") -> DataFrame:
    return _report(df, check, whitespace_condition(col), keep or df.columns)


def not_in_set(df: DataFrame, col: str, values: Iterable, keep: Sequence = (),
               check: str = "value outside allowed set") -> DataFrame:
    return _report(df, check, not_in_set_condition(col, values), keep or df.columns)


def out_of_range(df: DataFrame, col: str, lo, hi, keep: Sequence = (),
                 check: str = "value out of range") -> DataFrame:
    return _report(df, check, out_of_range_condition(col, lo, hi), keep or df.columns)


def future_timestamps(df: DataFrame, col: str, as_of=None, keep: Sequence = (),
                      check: str = "future timestamps") -> DataFrame:
    return _report(df, check, future_condition(df, col, as_of), keep or df.columns)


def precedes(df: DataFrame, expected_first, expected_later, keep: Sequence = (),
             check: str = "out of order") -> DataFrame:
    return _report(df, check, precedes_condition(expected_first, expected_later),
                   keep or df.columns)


# --------------------------------------------------------------------------- V2 duplicates
#: Classes of key hashes that ``duplicate_keys(hashed=True)`` tells apart before any text moves.
HASH_SLOTS = 1 << 20


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str, id_col: str | None = None,
                   check: str = "key occurs more than once", hashed: bool = False,
                   salts: int | None = None, tasks: int | None = None) -> DataFrame:
    """Rows whose (non-null) key occurs more than once.

    Output is long: one row per offending row (``check, keys..., id, cnt``), or
    one row per duplicated key (``check, keys..., cnt``) when ``id_col`` is None.
    An array of all ids per key would put a hot key's whole group into one row.

    Joining the rows back to their key's count would send a hot key (say a
    third of the table) to one task, and AQE cannot split that join because
    one side is an aggregate.  So every row gets a salt (a hash of the row; as
    many salts as shuffle partitions unless given): counts are taken per (key,
    salt), the key totals come from a window over at most ``salts`` rows per
    key, and the rows meet their totals on (key, salt) - a hot key is spread
    over ``salts`` tasks.

    ``hashed=True`` is for wide keys (whole texts).  An 8-byte hash of the key is
    counted first (map-side, so no text moves), and the classes (hash modulo
    ``HASH_SLOTS``) of repeated hashes are broadcast: at most 2**20 numbers,
    whatever the data.  Only rows of those classes take part in the salted
    exchange above, which works on the exact key, so a collision cannot create a
    false duplicate; where most classes hold a repeated key, most rows move.

    ``tasks`` (for large tables, see ``skew.tasks_for``) deals the rows, counts
    and totals to so many tasks, each with a bounded number of keys.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    salts = salts or tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    cols = keys + ([id_col] if id_col else [])
    base = base.select(*cols)
    if hashed:
        h = F.xxhash64(*[F.col(k) for k in keys])
        repeated = base.select(h.alias("_h")).groupBy("_h").count().where(F.col("count") > 1)
        classes = repeated.select(F.pmod("_h", F.lit(HASH_SLOTS)).alias("_class")).distinct()
        base = (base.withColumn("_class", F.pmod(h, F.lit(HASH_SLOTS)))
                .join(F.broadcast(classes), "_class", "left_semi").drop("_class"))
    if id_col is None:
        if tasks:
            base = base.repartition(tasks, *keys)       # a hot key's rows are counted by one task as they come
        counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)
        return counts.select(F.lit(check).alias("check"), *keys, "cnt")
    salted = base.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
    if tasks:
        salted = salted.repartition(tasks, *keys, "_salt")
    per_salt = salted.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    if tasks:
        per_salt = per_salt.repartition(tasks, *keys)
    totals = (per_salt.withColumn("cnt", F.sum("_n").over(Window.partitionBy(*keys)))
              .where(F.col("cnt") > 1).select(*keys, "_salt", "cnt"))
    if tasks:
        totals = totals.repartition(tasks, *keys, "_salt")
    return (salted.join(totals, keys + ["_salt"])
            .select(F.lit(check).alias("check"), *keys, F.col(id_col), "cnt"))


# --------------------------------------------------------------------------- V7, V10, V11
def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, keep: Sequence = (),
            check: str = "reference to missing parent", tasks: int | None = None) -> DataFrame:
    """Rows of ``child`` whose ``fk`` no parent has; ``tasks`` as in ``relational.anti``."""
    if tasks and all(isinstance(k, str) for k in keep):           # only what is kept is moved
        child = child.select(*dict.fromkeys([*(keep or [fk]), fk]))
    out = anti(child, fk, parent, pk, tasks)
    return out.select(F.lit(check).alias("check"), *[_c(k) for k in (keep or [fk])])


def childless(parent: DataFrame, pk: str, child: DataFrame, fk: str, keep: Sequence = (),
              check: str = "nothing refers to this row") -> DataFrame:
    """Parents no child refers to.  A LEFT ANTI join replaces LEFT JOIN + GROUP BY
    + HAVING count(child) = 0 (same rows when ``pk`` is unique).

    The child references are de-duplicated first: a parent referenced by a
    third of all children would otherwise be a right-side skew, which AQE's
    skew-join split does not cover for anti joins.  The distinct combines
    map-side and hash-partitions on the join key, so the join needs no further
    exchange on that side."""
    refs = child.select(F.col(fk).alias("_fk")).where(F.col("_fk").isNotNull()).distinct()
    out = parent.join(refs, F.col(pk) == F.col("_fk"), "left_anti")
    return out.select(F.lit(check).alias("check"), *[_c(k) for k in (keep or parent.columns)])


def matching_parent_attr(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                         child_attr: str, parent_attr: str, keep: Sequence = (),
                         check: str = "same value as the row referred to") -> DataFrame:
    """Children whose attribute equals the referenced parent's attribute.  In the
    output ``parent_attr`` is the parent's value, also where the child has a
    column of that name."""
    p = parent.select(F.col(pk).alias("_pk"), F.col(parent_attr).alias("_pattr"))
    j = child.where(F.col(child_attr).isNotNull()).join(p, F.col(fk) == F.col("_pk"))
    out = j.where(F.col(child_attr) == F.col("_pattr"))
    return out.select(F.lit(check).alias("check"), *[
        F.col("_pattr").alias(parent_attr) if k == parent_attr else _c(k) for k in (keep or child.columns)])


# --------------------------------------------------------------------------- V12
def row_counts(tables: Mapping[str, DataFrame], label: str = "counts: ") -> DataFrame:
    """One row per table: ``what, cnt``.  Each count is a global aggregate whose
    partial counts are combined map-side."""
    parts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(label + name).alias("what"), "cnt")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
