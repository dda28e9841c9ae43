"""Row predicates used by the cleaning and validation operators."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_not_null(cols: Iterable[str]) -> Column:
    """Conjunction of IS NOT NULL.  Unlike ``dropna`` (AtLeastNNonNulls) this is
    pushed into the parquet scan."""
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols], F.lit(True))


def any_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def is_blank(c) -> Column:
    """Empty after trimming spaces (PostgreSQL btrim / DuckDB trim)."""
    return F.btrim(_c(c)) == ""


def untrimmed(c) -> Column:
    return _c(c) != F.btrim(_c(c))


def contains_ci(c, needle: str) -> Column:
    """lower(c) LIKE '%needle%'."""
    return F.lower(_c(c)).like(f"%{needle.lower()}%")
