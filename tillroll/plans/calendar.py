"""Calendar dimensions.

A calendar is generated with ``sequence`` + ``explode`` (a recursive CTE stops
at Spark's recursion limit long before a year of days).  Its size is bounded by
the date span, never by the data, so joining it to facts may broadcast it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import is_weekend, week_monday_based, weekday_sunday1


def _spine(frame: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    return frame.select(F.explode(F.sequence(start.cast("date"), end.cast("date"),
                                             F.expr("INTERVAL 1 DAY"))).alias(name))


def _iso(df: DataFrame, d: str) -> DataFrame:
    c = F.col(d)
    return df.select(
        c.alias("date"),
        F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day"),
        F.date_format(c, "E").alias("day_of_week"),
        is_weekend(c).alias("is_weekend"),
        F.weekofyear(c).alias("week_of_year"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).alias("quarter"))


def _strftime(df: DataFrame, d: str) -> DataFrame:
    c = F.col(d)
    return df.select(
        c.alias("calendar_date"),
        F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day"),
        weekday_sunday1(c).alias("weekday"),          # 1 = Sunday
        week_monday_based(c).alias("week"))           # strftime('%W') + 1


_FLAVOURS = {"iso": _iso, "strftime": _strftime}


def calendar(spark: SparkSession, start: str, end: str, flavour: str = "iso") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    one = spark.range(1)
    return _FLAVOURS[flavour](_spine(one, F.lit(start), F.lit(end), "_d"), "_d")


def calendar_for(facts: DataFrame, date_col: str, flavour: str = "iso") -> DataFrame:
    """Calendar covering the dates of ``facts[date_col]``: min/max is a global
    aggregate (partial per task), the spine is generated from that one row."""
    span = facts.agg(F.min(F.col(date_col).cast("date")).alias("_lo"),
                     F.max(F.col(date_col).cast("date")).alias("_hi"))
    return _FLAVOURS[flavour](_spine(span, F.col("_lo"), F.col("_hi"), "_d"), "_d")


def load_calendar(spark: SparkSession, name: str, start: str, end: str) -> DataFrame:
    """Create the Calendar table (strftime flavour) and fill it with
    INSERT ... SELECT; re-running replaces the rows (truncate and reload)."""
    from tillroll.sources.catalog import create_table, insert_select
    from tillroll.sources.schemas import CALENDAR
    create_table(spark, name, CALENDAR)
    insert_select(calendar(spark, start, end, "strftime"), name, truncate=True)
    return spark.table(name)
