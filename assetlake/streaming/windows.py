"""Sliding-window sensor statistics, 3-sigma anomalies, threshold alerts and the aggregate envelope."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.operators.ordering import exact_quantiles, match_on, wide_quantiles
from assetlake.streaming.state import sliding_windows

# Window length, emission interval and alert thresholds (warning, critical).
WINDOW = "60 seconds"
SLIDE = "10 seconds"
LIMITS = {"temperature": (80.0, 90.0), "vibration": (60.0, 75.0), "pressure": (140.0, 160.0)}

KEYS = ["equipment_id", "sensor", "window_start", "window_end"]
STATISTICS = ["count", "mean", "median", "std", "min", "max", "range"]


def _simple_statistics() -> list[Column]:
    return [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.max("value") - F.min("value")).alias("range"),
    ]


def _milliseconds(interval: str) -> int:
    """A fixed interval such as "10 seconds" in milliseconds."""
    return round(pd.Timedelta(interval).total_seconds() * 1000)


def stream_statistics(
    series: DataFrame, window: str = WINDOW, slide: str = SLIDE, delay: str = "60 seconds", resolution: float | None = None
) -> DataFrame:
    """Statistics and 3-sigma anomalies per closed window of a stream (append mode).

    ``series``: equipment_id, sensor, value, event_time. Readings are first counted by (machine, sensor, pane, value) in
    panes of ``slide``; a closed pane's counts go to the state of its series, which merges them to windows. State
    holds distinct values; ``resolution`` rounds values to multiples and so bounds them by the sensor's range.
    """
    value = F.col("value") if resolution is None else F.round(F.col("value") / resolution) * resolution
    panes = (
        series.withWatermark("event_time", delay)
        .withColumn("value", value)
        .groupBy("equipment_id", "sensor", F.window("event_time", slide).alias("w"), "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("value IS NOT NULL")
        .select("equipment_id", "sensor", F.window_time("w").alias("event_time"), F.unix_millis("w.start").alias("pane"), "value", "n")
    )
    closed = sliding_windows(panes, _milliseconds(window), _milliseconds(slide))
    return closed.select(
        "equipment_id",
        "sensor",
        F.timestamp_millis("start_ms").alias("window_start"),
        F.timestamp_millis("end_ms").alias("window_end"),
        *STATISTICS,
        "anomalies",
        F.size("anomalies").alias("anomaly_count"),
    )


def _windowed(series: DataFrame, window: str, slide: str) -> DataFrame:
    return series.withColumn("w", F.window("event_time", window, slide)).select(
        "equipment_id",
        "sensor",
        "value",
        "event_time",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
    )


def batch_statistics(series: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """The same statistics over stored readings; medians come from the distributed exact quantile."""
    rows = _windowed(series, window, slide)
    medians = wide_quantiles(exact_quantiles(rows, ["value"], [0.5], KEYS), {("value", 0.5): "median"}, KEYS)
    return match_on(rows.groupBy(*KEYS).agg(*_simple_statistics()), medians, KEYS).select(*KEYS, *STATISTICS)


def batch_anomalies(series: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """One row per anomalous reading and window; kept as rows because a stored window may be large."""
    rows = _windowed(series, window, slide)
    spread = rows.groupBy(*KEYS).agg(F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_std"))
    apart = (F.col("_std") > 0) & (F.abs(F.col("value") - F.col("_mean")) > 3 * F.col("_std"))
    return match_on(rows, spread, KEYS).filter(apart).drop("_mean", "_std")


def alert_level(limits: dict[str, tuple[float, float]] = LIMITS) -> Column:
    """Level of the window maximum against its sensor's thresholds."""
    level = F.lit("normal")
    for sensor, (warning, critical) in limits.items():
        mine = F.col("sensor") == sensor
        level = (
            F.when(mine & (F.col("max") >= critical), F.lit("critical"))
            .when(mine & (F.col("max") >= warning), F.lit("warning"))
            .otherwise(level)
        )
    return level


def with_alert_level(statistics: DataFrame, limits: dict[str, tuple[float, float]] = LIMITS) -> DataFrame:
    return statistics.withColumn("alert_level", alert_level(limits))


def threshold_alerts(statistics: DataFrame, limits: dict[str, tuple[float, float]] = LIMITS) -> DataFrame:
    """One alert per (machine, sensor, window) above its warning or critical threshold."""
    raised = with_alert_level(statistics, limits).filter(F.col("alert_level") != "normal")
    start = F.date_format("window_start", "yyyyMMddHHmmss")
    return raised.select(
        F.concat_ws("_", F.lit("alert"), "equipment_id", "sensor", start, "alert_level").alias("alert_id"),
        "equipment_id",
        "sensor",
        F.col("max").alias("value"),
        F.col("alert_level").alias("level"),
        "window_start",
        F.col("window_end").alias("timestamp"),
        F.concat(
            F.col("sensor"), F.lit(" "), F.col("alert_level"), F.lit(" alert: "), F.format_string("%.2f", "max")
        ).alias("message"),
    )


def envelope(levelled: DataFrame, period_seconds: int = 60, version: str = "1.0") -> DataFrame:
    """One message per machine and window with the statistics of its sensors (a few per machine)."""
    members = [c for c in [*STATISTICS, "anomaly_count", "alert_level"] if c in levelled.columns]
    entry = F.struct(F.col("sensor").alias("key"), F.struct(*members).alias("value"))
    return levelled.groupBy("equipment_id", F.col("window_end").alias("timestamp")).agg(
        F.lit(period_seconds).alias("aggregation_period"),
        F.map_from_entries(F.collect_list(entry)).alias("results"),
        F.create_map(F.lit("version"), F.lit(version)).alias("metadata"),
    )
