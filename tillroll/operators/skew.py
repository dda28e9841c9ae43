"""Joins that spread very common keys, and only those.

Which keys are common is measured by a sketch of bounded size
(``approx_top_k``: a mergeable frequent-items summary, partially aggregated on
every task) over the key columns of the large side.  The measurement is a
scalar subquery of the join's own plan: nothing runs while the plan is built,
and both sides use the same subquery.  The large side's rows of a common key
get a salt, the small side's rows of that key are repeated once per salt; all
other keys keep salt 0 and are neither repeated nor moved elsewhere.

``tiled_join`` is for few keys with very many rows on both sides, whose result
is far larger than its inputs: tasks get tiles of the result, not keys.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that the sketch follows and that may be called common, at most (64 kB and 2 kB a task).
TRACKED, MOST = 4096, 128
#: A key is common if it holds more than this share of the rows; its rows then go to so many tasks.
SHARE, SALTS = 0.02, 16
#: Rows of a large table that a task gets where tasks are counted by rows, and tasks below which they aren't.
ROWS_EACH, FEW_TASKS = 250_000, 5


def tasks_for(rows: int) -> int | None:
    """Tasks for a step that holds or sorts ``rows`` rows; None (Spark's own number) for a small table.

    The session's number of shuffle partitions is fixed and AQE merges them by
    their compressed bytes, which for narrow rows is millions a task; the memory
    of a task then grows with the table.  ``repartition`` by this number isn't merged."""
    tasks = math.ceil(rows / ROWS_EACH)
    return tasks if tasks >= FEW_TASKS else None


def key_hash(keys: Sequence[str]) -> Column:
    """One long for the key columns, the same whatever integer type either side has."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def common_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> Column:
    """Hashes of the keys that hold more than ``share`` of the rows, as an array (a scalar subquery).

    The sketch never misses a key above the share as long as it follows more
    than ``1 / share`` keys; a key it calls common by mistake costs some
    repeated rows.  A null key counts like any other."""
    if share * TRACKED <= 1:
        raise ValueError(f"a share of {share} needs more than {TRACKED} followed keys")
    top = (df.select(key_hash(keys).alias("h"))
           .agg(F.expr(f"approx_top_k(h, {MOST}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")))
    return top.select(F.transform(F.filter("top", lambda t: t["count"] > F.lit(share) * F.col("n")),
                                  lambda t: t["item"]).alias("h")).scalar()


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", share: float = SHARE,
                salts: int = SALTS, measure: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` for an inner, left or left_anti join, with ``big``'s common keys over ``salts`` tasks.

    The result is the plain join's: each row of ``big`` still meets each matching
    row of ``small`` once.  ``measure`` is a cheaper frame with the same keys
    (default ``big``).  Rows of a common key are dealt by a hash of the whole
    row, so equal rows stay together.  Null keys match nothing; in a left or
    left_anti join they are spread like others.  With ``tasks`` both sides are
    dealt to so many tasks (see ``tasks_for``); AQE doesn't split those, salts do."""
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"not for a {how} join")
    keys = list(keys)
    hot = common_keys(measure if measure is not None else big, keys, share)
    plain = [F.col(f"`{f.name}`") for f in big.schema.fields
             if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    is_hot = F.array_contains(hot, key_hash(keys))
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies))
    if tasks:
        left, right = (side.repartition(tasks, *[F.col(f"`{k}`") for k in keys], "_salt") for side in (left, right))
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def tiled_join(left: DataFrame, right: DataFrame, keys: Sequence[str], groups: int | None = None,
               store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``left.join(right, keys)``, an inner join, with the pairs of a key over many tasks.

    The rows of either side are dealt into ``groups`` (default: the root of the
    session's shuffle partitions) by a hash of the row; each group of one side
    meets each of the other as a tile, so inputs are repeated ``groups`` times,
    which is little beside the pairs.  Tiles are dealt over a fixed number of
    partitions, since AQE would merge them by the bytes of the inputs and not of
    the pairs.  A task holds its tiles' rows, never its pairs.  ``store`` (a
    checkpoint) is applied to the repeated inputs."""
    tasks = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = groups or math.ceil(math.sqrt(tasks))
    at = [*keys, "_left", "_right"]

    def dealt(df, mine, other):
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields
                 if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
        df = store(df.withColumn(mine, F.pmod(F.xxhash64(*plain), F.lit(groups)).cast("int")))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(tasks, *at)

    return dealt(left, "_left", "_right").join(dealt(right, "_right", "_left"), at).drop("_left", "_right")
