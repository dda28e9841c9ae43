"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators assume.

    AQE stays on: it coalesces small shuffle partitions, converts joins to
    broadcast when the measured side is under the threshold and splits skewed
    sort-merge partitions.  The session time zone is UTC so that timestamp
    literals mean the same thing on every executor.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors run on one machine."""
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location (per application).

    The location comes from ``spark.checkpoint.dir``.  On a cluster it has to be
    set: executors can't be assumed to share any other folder.  Only a local
    master (tests) falls back to a folder beside the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    # one subfolder per application, as Spark's own checkpoints do
    app = spark.conf.get("spark.app.id", None) or "app"
    return "/".join([base.rstrip("/"), "tillroll", app, *parts])


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"

