"""Throughput statistics of a stream, from one row written with every micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = "batch long, processed long, failed long, seconds double"


def metered(write: Callable[[DataFrame, int], None], path: str, failed: Column) -> Callable[[DataFrame, int], None]:
    """foreachBatch function around ``write`` that stores the batch's rows, failed rows and seconds under ``path``.

    The persisted batch is computed once, for ``write`` and the counts. A replayed batch overwrites its own row. (An
    ``Observation`` would do without, but once a session has one, fitted logistic models can't be sent to tasks.)
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            started = time.monotonic()
            write(kept, batch_id)
            seconds = time.monotonic() - started
            seen = kept.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(failed, 1)).alias("failed")).first()
        finally:
            kept.unpersist()
        row = (batch_id, seen["rows"] - seen["failed"], seen["failed"], seconds)
        batch.sparkSession.createDataFrame([row], METRICS).write.mode("overwrite").parquet(f"{path}/part={batch_id}")

    return run


def throughput(spark: SparkSession, path: str) -> DataFrame:
    """One row over all micro-batches ever stored: batches, processed, failed, rate and times of a batch."""
    rows = spark.read.schema(METRICS + ", part long").parquet(path)
    total = F.sum("seconds")
    return rows.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("processed").alias("processed"),
        F.sum("failed").alias("failed"),
        (F.sum(F.col("processed") + F.col("failed")) / F.nullif(total, F.lit(0.0))).alias("rows_per_second"),
        F.avg("seconds").alias("avg_batch_s"),
        F.min("seconds").alias("min_batch_s"),
        F.max("seconds").alias("max_batch_s"),
    )


def late_rows(query) -> int:
    """Rows that the state operators of the last micro-batches dropped behind the watermark."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p.get("stateOperators", []))
