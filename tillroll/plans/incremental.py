"""Summaries that are kept between runs and take in new rows without reading the old ones.

A stored summary holds, per period (month), key and batch, the number of rows,
sums, and optionally a sketch of distinct values: everything that merges.
Averages, totals and approximate distinct counts are derived when it is read.

``take_in`` adds a slice of rows under a batch name.  Only the partitions of the
months that the slice touches are written (dynamic partition overwrite); a batch
that is taken in again, say after a failure between two partitions, replaces
what it contributed before.  One writer at a time is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import mean_of
from tillroll.sources.catalog import checkpoint

#: Size of a distinct sketch: 2^12 registers, a standard error of 1.04 / 64 = 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


@dataclass(frozen=True)
class Summary:
    """What a stored summary holds: its period, keys, summed columns and the column whose distinct values are sketched."""
    name: str
    period: Column
    keys: Mapping[str, Column]
    sums: Mapping[str, Column]
    distinct: Column | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        """``df`` aggregated per period and key (map-side first); a null distinct value isn't counted."""
        measures = [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(k) for k, c in self.sums.items()]]
        if self.distinct is not None:
            measures.append(F.hll_sketch_agg(self.distinct, F.lit(SKETCH_BITS)).alias("sketch"))
        return (df.select("*", self.period.alias("_period"), *[c.alias(f"_{k}") for k, c in self.keys.items()])
                .groupBy("_period", *[f"_{k}" for k in self.keys]).agg(*measures)
                .select(*[F.col(f"_{k}").alias(k) for k in self.keys], "n", *self.sums,
                        *(["sketch"] if self.distinct is not None else []), F.col("_period").alias("period")))


def _stored(rows: DataFrame, batch: str) -> DataFrame:
    first = [c for c in rows.columns if c != "period"]
    return rows.select(F.lit(batch).alias("batch"), *first, "period")


def _replace_months(rows: DataFrame, name: str) -> None:
    """Write ``rows`` over the partitions of their periods; others stay.  (``insertInto`` takes the mode from the session.)"""
    spark = rows.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.hint("rebalance", F.col("period")).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def create(summary: Summary, df: DataFrame, batch: str, path: str | None = None) -> None:
    """Store the summary of ``df`` as a table partitioned by period (null periods are a partition too)."""
    w = _stored(summary.rows(df), batch).hint("rebalance", F.col("period")).write.mode("overwrite").partitionBy("period")
    (w.option("path", path) if path else w).saveAsTable(summary.name)


def take_in(summary: Summary, spark: SparkSession, df: DataFrame, batch: str) -> None:
    """Add the rows of ``df`` under ``batch``; the same batch taken in before is replaced.

    Months where the batch had rows and has none any more keep an empty row of
    it, since a dynamic overwrite leaves partitions without rows alone."""
    stored = spark.table(summary.name)
    new = checkpoint(_stored(summary.rows(df), batch))
    mine = stored.where(F.col("batch") == batch).select("period")
    touched = checkpoint(new.select("period").union(mine).distinct())
    months = touched.agg(F.collect_set("period").alias("p")).scalar()
    here = F.array_contains(months, F.col("period"))
    if touched.where("period is null").limit(1).count():
        here = here | F.col("period").isNull()
    others = stored.where(here & (F.col("batch") != batch))
    gone = touched.join(new.select("period"), touched["period"].eqNullSafe(new["period"]), "left_anti")
    empty = gone.select(F.lit(batch).alias("batch"), *[
        (F.lit(0) if f.name == "n" or f.name in summary.sums else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in stored.schema.fields if f.name not in ("batch", "period")], "period")
    # the touched months are read in full before their partitions are replaced
    out = checkpoint(others.unionByName(new).unionByName(empty).select(*stored.columns))
    _replace_months(out, summary.name)


def read(summary: Summary, spark: SparkSession) -> DataFrame:
    """Per period and key: n, the sums, and ``n_distinct`` (estimated) where values are sketched."""
    measures = [F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in summary.sums]]
    if summary.distinct is not None:
        measures.append(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    return (spark.table(summary.name).where("n > 0").groupBy("period", *summary.keys).agg(*measures))


def compact(summary: Summary, spark: SparkSession, before, batch: str = "compacted") -> None:
    """Fold the batches of the months before ``before`` into one row each; those batches can't be taken in again."""
    stored = spark.table(summary.name).where((F.col("period") < F.lit(before)) & (F.col("n") > 0))
    measures = [F.sum("n").alias("n"), *[F.sum(k).cast(stored.schema[k].dataType).alias(k) for k in summary.sums]]
    if summary.distinct is not None:
        measures.append(F.hll_union_agg("sketch").alias("sketch"))
    rows = stored.groupBy(*summary.keys, "period").agg(*measures).withColumn("batch", F.lit(batch))
    rows = checkpoint(rows.select(*spark.table(summary.name).columns))
    _replace_months(rows, summary.name)


# --------------------------------------------------------------------------- the order summaries
def order_totals(name: str) -> Summary:
    """Order totals per month: Q15, Q16 and Q17 are derived from it."""
    return Summary(name, F.trunc(F.col("created_at").cast("date"), "MM"), {}, {"total": F.col("total_amount")})


def monthly_order_stats(summary: Summary, spark: SparkSession) -> DataFrame:
    """Q17 from the stored sums and counts."""
    return read(summary, spark).select(
        F.col("period").alias("month"), mean_of("total", "n").alias("avg_order_value"),
        F.col("total").cast("double").alias("month_total_revenue"), F.col("n").alias("orders_count")).orderBy("month")


def category_quantities(name: str) -> Summary:
    """Sold quantity per month and category (rows: created_at, category_id, quantity)."""
    return Summary(name, F.trunc(F.col("created_at").cast("date"), "MM"), {"category_id": F.col("category_id")},
                   {"total_quantity": F.col("quantity").cast("long")})


def returned_orders(name: str) -> Summary:
    """Distinct returned orders per month as stored sketches (rows: order_id, returned_at)."""
    return Summary(name, F.trunc(F.col("returned_at").cast("date"), "MM"), {}, {}, F.col("order_id"))


def returned_orders_by_month(summary: Summary, spark: SparkSession) -> DataFrame:
    """Q19 from the stored sketches."""
    return read(summary, spark).select(F.col("period").alias("month"), F.col("n_distinct").alias("returned_orders_count"))


def taken_in_slices(summary: Summary, df: DataFrame, slices: Sequence[Column], path: str | None = None) -> None:
    """Create the summary from the first slice (a condition on ``df``) and take in the others in turn."""
    create(summary, df.where(slices[0]), "slice-0", path)
    for i, rows in enumerate(slices[1:], 1):
        take_in(summary, df.sparkSession, df.where(rows), f"slice-{i}")
