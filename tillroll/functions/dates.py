"""Date helpers.  All of them are built-in Catalyst expressions (codegen'd).

Months and weeks are returned as DATE so that a result does not depend on the
session time zone: ``date_trunc`` on a ``timestamp_ntz`` column yields a
session-zone ``timestamp`` in Spark, while the cast to DATE is zone-free.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month, as DATE (``date_trunc('month', ts)::date``)."""
    return F.trunc(_c(c).cast("date"), "MM")


def week_start(c) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(_c(c).cast("date"), "week")


def weekday_sunday1(c) -> Column:
    """1 = Sunday ... 7 = Saturday (the value behind strftime('%w') + 1)."""
    return F.dayofweek(_c(c))


def week_monday_based(c) -> Column:
    """strftime('%W') + 1: week of year where weeks start on Monday and the days
    before the first Monday are week 1 (week 0 of %W)."""
    d = _c(c).cast("date")
    return (F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7) + 1).cast("int")


def is_weekend(c) -> Column:
    return F.dayofweek(_c(c)).isin(1, 7)


def week_id(c) -> Column:
    """Monday of the ISO week as an integer yyyymmdd (a sortable week key).
    Integer arithmetic on the date fields: no string formatting per row."""
    w = week_start(c)
    return F.year(w) * 10000 + F.month(w) * 100 + F.dayofmonth(w)
