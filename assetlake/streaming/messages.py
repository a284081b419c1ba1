"""Parsing, typing, validation and enrichment of sensor messages (batch or streaming frames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.text import parse_iso
from assetlake.operators import features as feat
from assetlake.operators import validation as val

MESSAGE_SCHEMA = (
    "equipment_id string, timestamp string, sensor_type string, data map<string,variant>, version string, "
    "producer_timestamp string, message_id string"
)
NUMERIC_KINDS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")
SENSORS = ("temperature", "vibration", "pressure", "rotation_speed", "power_consumption")


def _is_number(member: Column) -> Column:
    return F.schema_of_variant(member).rlike(f"^({'|'.join(NUMERIC_KINDS)})")


def compute_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns that later steps refer to many times.

    A plain projection would be merged into its consumers and evaluated once per reference; the generator keeps it
    a step of its own.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def parse(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text to typed columns; ``data`` keeps its numeric members only, ``raw`` the original text."""
    text = raw.select(F.col(value_col).cast("string").alias("raw"))
    parsed = compute_once(text, F.from_json("raw", MESSAGE_SCHEMA).alias("_m"))
    numbers = F.map_filter("_m.data", lambda _, v: v.isNotNull() & _is_number(v))
    typed = compute_once(
        parsed,
        F.transform_values(numbers, lambda _, v: F.try_variant_get(v, "$", "double")).alias("data"),
        parse_iso("_m.timestamp").alias("event_time"),
    )
    return typed.select("_m.equipment_id", "event_time", "data", "_m.sensor_type", "_m.message_id", "raw")


def usable() -> Column:
    """An entity, a readable time and at least one numeric member."""
    has_entity = F.col("equipment_id").isNotNull() & (F.col("equipment_id") != "")
    return F.coalesce(has_entity & F.col("event_time").isNotNull() & (F.size("data") > 0), F.lit(False))


def split_usable(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.filter(usable()), parsed.filter(~usable())


def series(parsed: DataFrame) -> DataFrame:
    """One row per numeric member: (equipment_id, sensor, value, event_time)."""
    return parsed.select("equipment_id", "event_time", F.explode("data").alias("sensor", "value"))


def with_sensor_columns(parsed: DataFrame, sensors: Sequence[str] = SENSORS) -> DataFrame:
    return compute_once(parsed, *[F.try_element_at("data", F.lit(s)).alias(s) for s in sensors])


def validate(sensor_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, refused rows with ``reasons``)."""
    checked = sensor_rows.withColumn("reasons", val.sensor_errors())
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def judge(sensor_rows: DataFrame) -> DataFrame:
    """Every message with ``usable`` and ``reasons``, as ``split_usable`` and ``validate`` part them, in one pass."""
    return compute_once(sensor_rows, usable().alias("usable"), val.sensor_errors().alias("reasons"))


def enrich(sensor_rows: DataFrame) -> DataFrame:
    return sensor_rows.withColumns({**feat.calendar_columns("event_time"), **feat.sensor_ratio_columns()})


def deduplicate(parsed: DataFrame, delay: str = "60 seconds") -> DataFrame:
    """Drop repeated message ids that arrive within the watermark delay."""
    return parsed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["message_id"])
