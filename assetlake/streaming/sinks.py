"""Sinks of the sensor stream: fan-out, idempotent offline writes, online upserts, keyed JSON."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assetlake.operators import store
from assetlake.sources.versioned import VersionedTable
from assetlake.streaming import messages

PARTS_A_BATCH = 2**20  # numbers kept for the parts of a micro-batch


def replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of one micro-batch as its own partition; a replay overwrites only that partition."""
    (
        df.withColumn("batch", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .option("compression", "zstd")
        .parquet(path)
    )


def fan_out(targets: dict[str, Callable[[DataFrame], DataFrame]], base: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing several projections of one persisted micro-batch under ``base``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, project in targets.items():
                replace_batch(project(kept), f"{base}/{name}", batch_id)
        finally:
            kept.unpersist()

    return write


def in_parts(
    write: Callable[[DataFrame, int], None], prepare: Callable[[DataFrame], DataFrame], rows_per_task: int, rows_per_part: int
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that deals a micro-batch into parts and hands them to ``write`` one after another, as smaller batches.

    A micro-batch is at least a file, whatever its size. What ``prepare`` makes of a row may be far larger than the row, so it is
    made for one part at a time and ``write`` may persist it: a part has about ``rows_per_part`` rows, its tasks ``rows_per_task``.
    The rows are parted by a hash of their values, without a shuffle (a slice is a filter on the source, read once for each), so a
    replay finds the same parts under the same numbers.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        scans = max(1, batch.rdd.getNumPartitions())
        slices = max(1, -(-batch.count() // (rows_per_task * scans)))
        together = max(1, rows_per_part // (rows_per_task * scans))
        slice_of = F.pmod(F.xxhash64(*batch.columns), F.lit(slices))
        for part, first in enumerate(range(0, slices, together)):
            cut = [prepare(batch.filter(slice_of == i)) for i in range(first, min(first + together, slices))]
            write(reduce(DataFrame.unionByName, cut), batch_id * PARTS_A_BATCH + part)

    return run


def sensor_targets(sensors: Sequence[str] = messages.SENSORS) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Offline rows, online rows, raw audit and refused messages of a parsed micro-batch."""

    def valid(parsed: DataFrame) -> DataFrame:
        good, _ = messages.split_usable(parsed)
        return messages.enrich(messages.validate(messages.with_sensor_columns(good, sensors))[0])

    def offline(parsed: DataFrame) -> DataFrame:
        rows = valid(parsed).withColumnRenamed("event_time", "timestamp")
        derived = ["hour", "day_of_week", "month", "is_weekend", "temperature_pressure_ratio", "vibration_energy"]
        return store.to_long(rows, [*sensors, *derived]).filter(F.col("feature_value").isNotNull())

    def online(parsed: DataFrame) -> DataFrame:
        rows = valid(parsed).select(
            "equipment_id",
            F.col("data").alias("features"),
            F.col("event_time").alias("timestamp"),
            F.current_timestamp().alias("ingestion_time"),
        )
        return store.online_state(rows)

    def refused(parsed: DataFrame) -> DataFrame:
        good, bad = messages.split_usable(parsed)
        _, invalid = messages.validate(messages.with_sensor_columns(good, sensors))
        unusable = bad.select("raw", F.array(F.lit("unusable message")).alias("reasons"))
        return unusable.unionByName(invalid.select("raw", "reasons"))

    def audit(parsed: DataFrame) -> DataFrame:
        return parsed.select("equipment_id", "message_id", "raw")

    return {"offline": offline, "online": online, "raw": audit, "refused": refused}


def upsert_online(table: VersionedTable) -> Callable[[DataFrame, int], None]:
    """foreachBatch function keeping a versioned online table at the newest row per entity by event time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        incoming = store.online_state(batch.select("equipment_id", "features", "timestamp", "ingestion_time"))
        current = table.read()
        if current is None:
            table.publish(incoming)
            return
        columns = ["equipment_id", "features", "timestamp", "ingestion_time"]
        table.publish(store.online_state(current.select(*columns).unionByName(incoming.select(*columns))))

    return write


def keyed_json(df: DataFrame, key: str = "equipment_id") -> DataFrame:
    """Key and JSON value of an outgoing message with its id and sending time."""
    stamped = df.withColumns(
        {
            "producer_timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "message_id": F.uuid(),
        }
    )
    return stamped.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def run_available(stream: DataFrame, checkpoint: str, **sink) -> StreamingQuery:
    """Process what is available now and stop; a rerun continues from the checkpoint."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if "foreach_batch" in sink:
        query = writer.foreachBatch(sink["foreach_batch"]).start()
    else:
        query = writer.outputMode(sink.get("mode", "append")).format(sink.get("format", "parquet")).start(sink["path"])
    query.awaitTermination()
    return query
