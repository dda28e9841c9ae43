"""Catalog tables: overwrite, materialize, source fallback, CTAS, statistics,
physical layout.  Tables are parquet (no Delta in this image).  Tables that the
user names are durable and managed by the catalog; intermediates are external
tables in new folders under the cluster's checkpoint folder (``scratch_path``)."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import is_local, shared_dir, unique_name


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, ddl: str, defaults: dict | None = None,
                 replace: bool = False) -> None:
    """CREATE TABLE name (ddl) USING parquet, with column DEFAULTs.

    ``ddl`` is a Spark DDL column list ("id bigint, status string, ...").
    Constraints (keys, CHECKs) are not enforced by parquet tables; they are
    expressed as validation checks (``tillroll.plans.suite``)."""
    cols = []
    for field in [f.strip() for f in re.split(r",(?![^()]*\))", ddl) if f.strip()]:
        col = field.split()[0]
        if defaults and col in defaults:
            field += f" DEFAULT {defaults[col]!r}" if isinstance(defaults[col], str) \
                else f" DEFAULT {defaults[col]}"
        cols.append(field)
    if replace:
        drop_table(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, and the former versions of a managed one."""
    info = _described(spark, name) if spark.catalog.tableExists(name) else {}
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if info.get("Type") == "MANAGED" and _VERSION in info.get("Location", ""):
        folder, leaf = info["Location"].rstrip("/").rsplit("/", 1)
        _free_versions(spark, folder, leaf.split(_VERSION)[0], keep=set())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, under the shared folder the
    cluster names in ``spark.checkpoint.dir``."""
    return shared_dir(spark, "tables", unique_name(name.replace(".", "__")))


def _durable(spark: SparkSession) -> None:
    """Named tables live in the warehouse, which executors have to share.

    Whether a folder is a mount that all machines have or a disk of this one, its
    name doesn't tell: a task has to read a file that the driver puts there."""
    place = spark.conf.get("spark.sql.warehouse.dir")
    if is_local(spark) or not (place.startswith("file:") or ":" not in place.split("/")[0]):
        return
    mark = spark._jvm.org.apache.hadoop.fs.Path(place, unique_name("tillroll_shared"))
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(mark)
    out.writeBytes("shared")
    out.close()
    try:
        seen = _read_by_a_task(spark, fs.makeQualified(mark).toString())
    finally:
        fs.delete(mark, False)
    if not seen:
        raise RuntimeError(f"the warehouse {place} is a machine-local folder; give a path or set spark.sql.warehouse.dir")


def _read_by_a_task(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.text(path).collect()[0].value == "shared"
    except Exception:       # the task's own error, whatever the file system
        return False


def overwrite(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Full-replace write of table ``name``; returns the table scan.

    Without ``path`` the table is managed: it lies where the catalog puts it and
    DROP TABLE frees its data.  With ``path`` (intermediates) it is external.

    A managed table that exists with the same columns is replaced by one catalog
    operation: the rows are written to a new folder beside the table's, then its
    location is moved there.  Readers see the old rows or the new ones, never
    none; ``df`` may read the table it replaces.  The version before stays until
    the next replacement, for readers that are still at it.  With other columns
    the new table is written as ``name__next``, the old one is dropped and the new
    one renamed; between the two readers find no table, and if the application
    ends there, the next call finishes the rename.  One writer a table is assumed."""
    spark = df.sparkSession
    if path:
        df.write.format(fmt).mode("overwrite").option("path", path).saveAsTable(name)
        return spark.table(name)
    _durable(spark)
    _recover(spark, name)
    if not spark.catalog.tableExists(name):
        df.write.format(fmt).saveAsTable(name)
    elif _columns(spark.table(name)) == _columns(df) and _provider(spark, name) == fmt:
        _move_to_new_version(df, name, fmt)
    else:
        df.write.format(fmt).mode("overwrite").saveAsTable(name + _NEXT)
        drop_table(spark, name)
        spark.sql(f"ALTER TABLE {name}{_NEXT} RENAME TO {_leaf(spark, name)}")
    return spark.table(name)


_NEXT, _VERSION = "__next", "__v_"


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in describe(spark, name).collect()}


def _provider(spark: SparkSession, name: str) -> str:
    """Format of a plain table; partitioned and bucketed ones have none that a folder of files could replace."""
    info = _described(spark, name)
    return "" if "# Partition Information" in info or "Bucket Columns" in info else info.get("Provider", "")


def _move_to_new_version(df: DataFrame, name: str, fmt: str) -> None:
    spark = df.sparkSession
    old = _described(spark, name)["Location"].rstrip("/")
    folder, leaf = old.rsplit("/", 1)
    base = leaf.split(_VERSION)[0]
    new = f"{folder}/{base}{_VERSION}{unique_name('t')}"
    df.write.format(fmt).save(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    _free_versions(spark, folder, base, keep={leaf, new.rsplit("/", 1)[1]})


def _free_versions(spark: SparkSession, folder: str, base: str, keep: set[str]) -> None:
    """Delete the folders of a table's versions, but for ``keep``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(place) if fs.exists(place) else ():
        found = status.getPath().getName()
        if (found == base or found.startswith(base + _VERSION)) and found not in keep:
            fs.delete(status.getPath(), True)


def _leaf(spark: SparkSession, name: str) -> str:
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def _recover(spark: SparkSession, name: str) -> None:
    """Finish or undo a replacement that broke off: the new table counts only if the old one is gone."""
    if spark.catalog.tableExists(name + _NEXT):
        if spark.catalog.tableExists(name):
            drop_table(spark, name + _NEXT)
        else:
            spark.sql(f"ALTER TABLE {name}{_NEXT} RENAME TO {_leaf(spark, name)}")


def insert_select(df: DataFrame, name: str, truncate: bool = False) -> None:
    """INSERT [OVERWRITE] INTO name SELECT ... (columns by position)."""
    df.write.insertInto(name, overwrite=truncate)


def materialize(df: DataFrame, name: str | None) -> DataFrame:
    """Store ``df`` as the managed table ``name`` and continue from the stored copy (see ``overwrite``).

    No name -> ``df`` unchanged."""
    return overwrite(df, name) if name else df


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut a long lineage with a reliable checkpoint in the shared folder
    (``spark.checkpoint.dir``), never a local one."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def resolve_source(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """The first existing table of ``names`` (catalog lookup, not exceptions)."""
    for n in names:
        if spark.catalog.tableExists(n):
            return spark.table(n)
    raise LookupError(f"none of the tables exists: {list(names)}")


def ctas(df: DataFrame, name: str, analyze: bool = True, path: str | None = None) -> DataFrame:
    """CREATE TABLE name AS SELECT, then ANALYZE so the optimizer sees its size."""
    out = overwrite(df, name, path=path)
    if analyze:
        compute_statistics(df.sparkSession, name)
    return out


def compute_statistics(spark: SparkSession, name: str, columns: bool = True) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else ""))


def write_layout(df: DataFrame, name: str, cluster_by: Sequence[str], buckets: int,
                 sort_by: Sequence[str] = (), codec: str = "zstd", path: str | None = None,
                 row_group_bytes: int | None = None) -> DataFrame:
    """Physical layout of a table: rows hashed into ``buckets`` by the join/group
    key (co-located joins and aggregations read it without an exchange), sorted
    within each bucket (parquet min/max statistics then skip row groups on
    range filters), compressed with ``codec``.

    Rows are dealt to the buckets first, by the same hash: one file a bucket, in
    order, instead of one per bucket and task.  A bucket holds whole keys, so a
    very common key makes a large bucket: ``sources.layout`` keeps such keys apart.
    ``row_group_bytes`` sets the size of parquet row groups (smaller: finer skipping)."""
    if path is None:
        _durable(df.sparkSession)
    w = (df.repartition(buckets, *cluster_by).write.format("parquet").mode("overwrite")
         .option("compression", codec).bucketBy(buckets, *cluster_by))
    if path:
        w = w.option("path", path)
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def write_partitioned(df: DataFrame, name: str | None, by: Sequence[str], path: str | None = None,
                      codec: str = "zstd") -> DataFrame:
    """A table stored by the values of ``by``, one folder each, so that scans prune whole folders.

    A REBALANCE hint deals the rows: AQE gives every folder files of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, splits a value that
    holds very many rows over several files and merges small ones, where a plain
    ``partitionBy`` writes up to one file per task and value.  With ``path``
    (intermediates) the folder is read back as it is, without a catalog entry."""
    spark = df.sparkSession
    w = (df.hint("rebalance", *[F.col(c) for c in by]).write.format("parquet").mode("overwrite")
         .option("compression", codec).partitionBy(*by))
    if path:
        w.save(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _durable(spark)
    w.saveAsTable(name)
    return spark.table(name)


def write_sized(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A table whose files have about the advised size, whatever the number of tasks that made its rows."""
    return overwrite(df.hint("rebalance"), name, path=path)


def temp_view(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> str:
    (df.select(*columns) if columns else df).createOrReplaceTempView(name)
    return name


def drop_view(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def schema_rows(df: DataFrame) -> DataFrame:
    """The columns of a frame as rows: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order`` (default: all columns that can be ordered), the same whatever the partitions."""
    keys = order or [f.name for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    return df.orderBy(*[F.col(f"`{k}`").asc_nulls_last() for k in keys]).limit(n)
