"""The same operators on a streaming source.

The reference has no streaming work; what carries over unchanged is the
row-level validation (stateless, one pass per micro-batch) and the sales totals
(a streaming aggregation whose state is one row per payment mode).  The
checkpoint lives in the shared folder, so a restarted query resumes where it
stopped.  A micro-batch that is run again after a restart overwrites the folder
of its batch id, so its rows are there once.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.money import exact_sum, line_total
from tillroll.plans import suite as SU
from tillroll.session import shared_dir


def stream_row_checks(stream: DataFrame, entity: str, checks: Sequence[SU.Check], as_of=None) -> DataFrame:
    """Violations of the row-level checks, row by row as data arrives."""
    bad = [c for c in checks if c.kind not in SU.ROW_KINDS]
    if bad:
        raise ValueError(f"only row-level checks run on a stream: {[c.name for c in bad]}")
    return SU._row_level(stream, [replace(c, entity=entity) for c in checks], as_of)


def stream_sales_by_payment(stream: DataFrame) -> DataFrame:
    """Running totals per payment mode (Complete or Update output mode)."""
    return (stream.groupBy("payment_mode")
            .agg(exact_sum(line_total("amount", "quantity")).alias("total_amount"),
                 F.count(F.lit(1)).alias("transactions")))


def write_batches(df: DataFrame, target: str, name: str, mode: str = "append",
                  available_now: bool = True) -> StreamingQuery:
    """Write each micro-batch to parquet at ``target/batch_id=<n>`` (read ``target``
    to see all).  Aggregations in Complete mode overwrite the target with the
    current totals."""
    ckpt = shared_dir(df.sparkSession, "streams", name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        place = target if mode == "complete" else f"{target}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(place)

    w = df.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.foreachBatch(sink).start()
