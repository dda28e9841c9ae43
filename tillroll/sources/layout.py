"""Tables laid out for joins on one key: co-located buckets, very common keys apart.

Both sides of a frequent join are bucketed by its key into the same number of
buckets, so the join reads them without an exchange.  A bucket holds whole keys,
so keys that hold more than a share of the rows (measured by a bounded sketch)
are stored in a table of their own with files of an even size; they meet the
other side's rows of those keys, which are few.  Inside the buckets rows are
sorted by time, so range filters skip row groups and pages.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.skew import SHARE, common_keys, key_hash
from tillroll.sources import catalog as IO


@dataclass(frozen=True)
class Layout:
    """A stored table: the bucketed part, the rows of very common keys, and those keys' hashes."""
    keys: Sequence[str]
    buckets: int
    cold: DataFrame
    hot: DataFrame
    hot_keys: Sequence[int]

    def all(self) -> DataFrame:
        return self.cold.unionByName(self.hot)


def _path(base: str | None, part: str) -> str | None:
    return f"{base}/{part}" if base else None


def store(df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (),
          share: float = SHARE, path: str | None = None, row_group_bytes: int | None = None) -> Layout:
    """Store ``df`` as ``name`` (bucketed by ``keys``) and ``name__hot`` (keys with more than ``share`` of the rows).

    The sketch names at most 128 keys; rows with a null key are bucketed like others
    unless they are that common."""
    found = df.sparkSession.range(1).select(common_keys(df, keys, share).alias("h")).first().h
    is_hot = key_hash(keys).isin(list(found)) if found else F.lit(False)
    cold = IO.write_layout(df.where(~is_hot), name, keys, buckets, sort_by, path=_path(path, "cold"),
                           row_group_bytes=row_group_bytes)
    hot = IO.write_sized(df.where(is_hot), name + "__hot", path=_path(path, "hot"))
    return Layout(list(keys), buckets, cold, hot, list(found))


def store_beside(df: DataFrame, name: str, facts: Layout, path: str | None = None) -> Layout:
    """Store the other side of a join with ``facts``: the same buckets, and the rows of the same common keys apart."""
    is_hot = key_hash(facts.keys).isin(list(facts.hot_keys)) if facts.hot_keys else F.lit(False)
    cold = IO.write_layout(df.where(~is_hot), name, facts.keys, facts.buckets, path=_path(path, "cold"))
    hot = IO.write_sized(df.where(is_hot), name + "__hot", path=_path(path, "hot"))
    return Layout(facts.keys, facts.buckets, cold, hot, facts.hot_keys)


def colocated_join(left: Layout, right: Layout) -> tuple[DataFrame, DataFrame]:
    """(bucketed part, common keys' part) of the inner join on the layouts' keys.

    The first reads both tables bucket by bucket without an exchange.  The second
    joins the common keys' rows; AQE broadcasts the right side, the rows of at
    most 128 keys, if it is small.  Both parts are kept apart so that an
    aggregation on the keys of the first needs no exchange either; keys occur in
    one part only."""
    if list(left.keys) != list(right.keys) or left.buckets != right.buckets or set(left.hot_keys) != set(right.hot_keys):
        raise ValueError("the two layouts differ in keys or buckets")
    return left.cold.join(right.cold, left.keys), left.hot.join(right.hot, left.keys)


def drop(layout_name: str, spark) -> None:
    for name in (layout_name, layout_name + "__hot"):
        IO.drop_table(spark, name)
