"""Helpers that several operators share: stored intermediates, components, workers."""

from __future__ import annotations

import os
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import shared_dir, unique_name

BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Lineage ends here: a lost executor costs a read of the files, not the work
    above them, and a result that several branches use is computed once.  The
    folder's retention removes the files; the exchanges' files, which nothing
    reads again, go when the write has ended."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", unique_name(name))
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    A cluster has it installed or on PYTHONPATH, as a driver in the
    repository's folder has; only otherwise is the package sent with the job."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT in paths or os.path.realpath(os.getcwd()) == ROOT or getattr(spark, "_tillroll_sent", False):
        return
    import shutil
    import tempfile
    base = os.path.join(tempfile.mkdtemp(prefix="tillroll-send-"), "tillroll_package")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", ROOT, "tillroll"))
    spark._tillroll_sent = True


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """``mapInArrow`` with the package available to the workers, in batches of a bounded number of rows.

    Rows hold whole texts, and a worker has a batch in several forms at a time;
    a session that sets its own batch size keeps it."""
    spark = df.sparkSession
    on_workers(spark)
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


#: Bits of a bit map of rows: so many each, up to 16 MB (2^21 broadcast rows of two longs).
BITS_EACH, MAX_BITS = 16, 27


def bit_map(rows: DataFrame) -> tuple[DataFrame, int]:
    """(map, bits) of a column ``row`` of digests: (word, mask), sized by their number, with a ceiling.

    A full map says "maybe" more often, never "no" for a row that is on it."""
    bits = min(MAX_BITS, max(10, (BITS_EACH * rows.count()).bit_length()))
    slot = F.col("row").bitwiseAND(F.lit((1 << bits) - 1))
    words = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("mask"))
    return cut(words, "bit_map"), bits


def _marked(df: DataFrame, words: DataFrame, bits: int, there: bool) -> DataFrame:
    slot = F.col("row").bitwiseAND(F.lit((1 << bits) - 1))
    hit = F.coalesce(F.expr("getbit(mask, cast(_slot % 64 as int)) = 1"), F.lit(False))
    out = df.withColumn("_slot", slot).withColumn("word", F.shiftright("_slot", 6))
    return out.join(F.broadcast(words), "word", "left").where(hit if there else ~hit).drop("word", "_slot", "mask")


def on_map(df: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose ``row`` may be on the map (broadcast: at most 2^21 words)."""
    return _marked(df, words, bits, True)


def off_map(df: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose ``row`` is surely not on the map."""
    return _marked(df, words, bits, False)


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the undirected edges (a, b) -> (node, component).

    ``component`` is the smallest node reachable; nodes without an edge to
    another node are absent.  Alternating large-star and small-star steps:
    every step is an aggregate that combines map-side plus a join that AQE can
    split, so a node with very many neighbours never meets them in one task,
    and the number of steps grows with the logarithm of the longest path.
    Each step's edges are stored, so lineage stays short.  Empty edges give an
    empty result; repeated edges and self-loops don't matter; an edge with a
    null end is no edge."""
    e = (edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = cut(e, name)
    while not _stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).union(low).distinct())
        e = cut(small, name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _stars(e: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, or only edges from larger ones."""
    ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or (up = 1 and down = 1)").limit(1).count()
