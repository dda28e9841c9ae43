"""Generic relational operators.

They are compositions of built-in DataFrame operators chosen for how they
behave on skewed data: survivors and winners come from aggregates that combine
map-side (``min`` of a struct) rather than from a window over the raw rows, so
one hot key never has to be sorted inside a single task.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.skew import salted_join


def _cols(cols) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def select_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the subset of ``cols`` that exists in ``df``."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k.  Catalyst plans TakeOrderedAndProject: each task
    keeps k rows and only those move to the final merge."""
    return df.orderBy(*order).limit(k)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the smallest by ``order`` (ascending, nulls
    first), ties broken by the remaining columns, so the survivor is unique.

    ``min(struct(...))`` is a partial aggregate: every task reduces its share of
    a key to one row before the shuffle, so a key holding a third of the table
    costs one row per task in the exchange.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    return (df.groupBy(*keys).agg(F.min(packed).alias("_s"))
            .select(*keys, *[F.col(f"_s.{c}").alias(c) for c in list(order) + rest])
            .select(*df.columns))


def best_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                   n: int = 1, rank_col: str = "_rn") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY ... ORDER BY ...) <= n.

    Spark inserts WindowGroupLimit before and after the exchange, so each task
    keeps only n rows per partition key.  Callers use it on pre-aggregated rows.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n).drop(rank_col)


def anti(child: DataFrame, fk: str, parent: DataFrame, pk: str, tasks: int | None = None) -> DataFrame:
    """Child rows with a non-null ``fk`` that matches no parent ``pk``.

    Written as a LEFT ANTI join; Catalyst does not rewrite LEFT JOIN ... IS NULL
    into this form by itself, and the anti join needs only the parent key.  A
    hot foreign key (a skewed left side) is split by AQE's skew join, which
    needs both sides to be plain shuffles: the parent keys are therefore not
    de-duplicated here (a parent key is unique in the data this checks).
    ``tasks`` (for large tables, see ``skew.tasks_for``) deals both sides to so
    many tasks; a hot key is then spread over them by salts.
    """
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    if tasks:
        return salted_join(child.where(F.col(fk).isNotNull()), keys.withColumnRenamed("_pk", fk), [fk], "left_anti",
                           salts=tasks, tasks=tasks)
    return (child.where(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("_pk"), "left_anti"))


def sorted_distinct_text(c: str, sep: str = ", ") -> Column:
    """Comma-separated sorted distinct values of ``c`` (aggregate expression)."""
    return F.array_join(F.sort_array(F.collect_set(F.col(c))), sep)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def left_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salts: int | None = None,
              measure: DataFrame | None = None) -> DataFrame:
    """LEFT JOIN on ``keys``; with ``salts`` the measured common keys are spread over that many tasks.

    AQE can't split a hot key where the right side of a sort-merge join is itself
    an aggregate, or where an aggregate above reuses the join's partitioning."""
    return salted_join(big, small, keys, "left", salts=salts, measure=measure) if salts else big.join(small, list(keys), "left")
