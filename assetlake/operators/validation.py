"""Rule tables, range and relationship checks, quarantine split (rows are never dropped silently)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.text import json_object
from assetlake.operators.ordering import match_on


@dataclass(frozen=True)
class RangeRule:
    """Inclusive numeric range of one column; ``flag`` names the rule in error objects."""

    column: str
    low: float | None
    high: float | None
    flag: str

    def outside(self) -> Column:
        """True outside the range, NULL for a NULL value."""
        value = F.col(self.column)
        broken = F.lit(False)
        if self.low is not None:
            broken = broken | (value < self.low)
        if self.high is not None:
            broken = broken | (value > self.high)
        return broken


# Physical ranges of the raw equipment records.
EQUIPMENT_RULES = (
    RangeRule("air_temperature_k", 290, 310, "air_temp_invalid"),
    RangeRule("process_temperature_k", 305, 320, "process_temp_invalid"),
    RangeRule("rotational_speed_rpm", 1000, 3000, "speed_invalid"),
    RangeRule("torque_nm", 0, 100, "torque_invalid"),
    RangeRule("tool_wear_min", 0, 300, "wear_invalid"),
)

# Required members and inclusive ranges of a sensor message.
SENSOR_RULES = (
    RangeRule("temperature", 0, 150, "temperature"),
    RangeRule("vibration", 0, 100, "vibration"),
    RangeRule("pressure", 0, 200, "pressure"),
)

# Further ranges of a scoring request.
REQUEST_SENSOR_RULES = SENSOR_RULES + (
    RangeRule("rotation_speed", 0, 5000, "rotation_speed"),
    RangeRule("power_consumption", 0, None, "power_consumption"),
)

# Request identifiers and types.
ID_PREFIXES = ("EQ-", "PUMP-", "COMP-", "TURB-")
EQUIPMENT_TYPES = ("pump", "compressor", "turbine", "generator", "conveyor")
MAX_AGE_DAYS = 7
MAX_BATCH = 1000


def null_out_of_range(df: DataFrame, rules: Sequence[RangeRule] = EQUIPMENT_RULES) -> DataFrame:
    return df.withColumns({r.column: F.when(~r.outside(), F.col(r.column)) for r in rules})


def validity_columns(rules: Sequence[RangeRule] = EQUIPMENT_RULES) -> dict[str, Column]:
    """``is_valid``: no measure missing. ``passes_rules``: none missing and none out of range."""
    present, passed = F.lit(True), F.lit(True)
    for r in rules:
        present = present & F.col(r.column).isNotNull()
        passed = passed & F.coalesce(~r.outside(), F.lit(False))
    return {"is_valid": present, "passes_rules": passed}


def error_object(rules: Sequence[RangeRule] = EQUIPMENT_RULES) -> Column:
    return json_object(*[r.outside().alias(r.flag) for r in rules])


def filter_batch(df: DataFrame, batch_id: str | None, column: str = "batch_id") -> DataFrame:
    return df if batch_id is None else df.filter(F.col(column) == batch_id)


def _failed(pairs) -> Column:
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in pairs]))


def broken_rules(rules: Sequence[RangeRule], extra: dict[str, Column] | None = None) -> Column:
    """Names of the CHECK rules a row breaks; like a CHECK, a NULL breaks none."""
    pairs = [(r.flag, r.outside()) for r in rules] + list((extra or {}).items())
    return _failed(pairs)


def split_by_rules(
    df: DataFrame, rules: Sequence[RangeRule], extra: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rejected rows with ``broken_rules``)."""
    checked = df.withColumn("broken_rules", broken_rules(rules, extra))
    return (
        checked.filter(F.size("broken_rules") == 0).drop("broken_rules"),
        checked.filter(F.size("broken_rules") > 0),
    )


def sensor_errors(rules: Sequence[RangeRule] = SENSOR_RULES) -> Column:
    """Reasons a sensor message is refused: a required member missing (or not numeric) or out of range."""
    pairs = []
    for r in rules:
        pairs.append((f"missing {r.column}", F.col(r.column).isNull()))
        pairs.append((f"{r.column} out of range", r.outside()))
    return _failed(pairs)


def relationship_errors() -> Column:
    hot_low = (F.col("temperature") > 100) & (F.col("pressure") < 50)
    shaking_cold = (F.col("vibration") > 70) & (F.col("temperature") < 60)
    return _failed(
        [
            ("High temperature with low pressure indicates sensor error", hot_low),
            ("High vibration with low temperature requires inspection", shaking_cold),
        ]
    )


def relationship_warnings(low_pressure: float = 50.0) -> Column:
    """Softer rule: the row stays valid but low pressure at a normal temperature is pointed out."""
    odd = (F.col("pressure") < low_pressure) & (F.col("temperature") <= 100)
    return _failed([("Possible sensor problem: low pressure at normal temperature", odd)])


def request_errors(as_of: str, id_col="equipment_id", type_col="equipment_type", ts_col="timestamp") -> Column:
    """Request rules against an explicit evaluation time."""
    now = F.lit(as_of).cast("timestamp_ntz")
    ident, ts = F.col(id_col), F.col(ts_col).cast("timestamp_ntz")
    prefixed = F.lit(False)
    for prefix in ID_PREFIXES:
        prefixed = prefixed | ident.startswith(prefix)
    return _failed(
        [
            ("id length", ident.isNull() | ~F.length(ident).between(3, 50)),
            ("id prefix", ~prefixed),
            ("type", ~F.col(type_col).isin(*EQUIPMENT_TYPES)),
            ("future timestamp", ts > now),
            ("too old", ts < now - F.expr(f"INTERVAL '{MAX_AGE_DAYS}' DAY")),
        ]
    )


def batch_size_check(df: DataFrame, batch_col: str = "batch_id", limit: int = MAX_BATCH) -> DataFrame:
    counted = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("requests"))
    return counted.withColumn("size_ok", F.col("requests").between(1, limit))


def range_message(column: str, low: float, high: float) -> Column:
    """NULL when the value lies in [low, high], otherwise what is wrong with it."""
    value = F.col(column)
    text = value.cast("string")
    return F.when(value < low, F.concat(F.lit(f"{column} "), text, F.lit(f" is less than minimum {low}"))).when(
        value > high, F.concat(F.lit(f"{column} "), text, F.lit(f" is greater than maximum {high}"))
    )


def validate_against_registry(
    values: DataFrame,
    registry: DataFrame,
    name_col: str = "feature_name",
    value_col: str = "feature_value",
) -> DataFrame:
    """Check long-form feature values (text or numeric) against registry rows.

    ``registry`` has (feature_name, feature_type, min_value, max_value, allowed_values); the size of the
    registry decides whether Spark broadcasts it. Adds ``valid`` and ``error``.
    """
    rules = registry.select(
        F.col("feature_name").alias(name_col), "feature_type", "min_value", "max_value", "allowed_values"
    )
    joined = match_on(values, rules.withColumn("_known", F.lit(True)), [name_col], "left")
    number = F.col(value_col).try_cast("double") if dict(values.dtypes)[value_col] == "string" else F.col(value_col)
    numeric = F.col("feature_type") == "numeric"
    categorical = F.col("feature_type") == "categorical"
    allowed = F.col("allowed_values")
    error = (
        F.when(F.col("_known").isNull(), F.lit("Feature not found"))
        .when(numeric & number.isNull(), F.lit("Expected numeric"))
        .when(numeric & (number < F.col("min_value")), F.lit("Value below minimum"))
        .when(numeric & (number > F.col("max_value")), F.lit("Value above maximum"))
        .when(
            categorical & (F.size(allowed) > 0)
            & F.coalesce(~F.array_contains(allowed, F.col(value_col).cast("string")), F.lit(True)),
            F.lit("Value not in allowed values"),
        )
    )
    checked = joined.withColumn("error", error).withColumn("valid", F.col("error").isNull())
    return checked.drop("_known", "feature_type", "min_value", "max_value", "allowed_values")


def entity_validity(checked: DataFrame, entity_col: str = "equipment_id") -> DataFrame:
    return checked.groupBy(entity_col).agg(
        F.bool_and("valid").alias("all_valid"), F.count(F.when(~F.col("valid"), 1)).alias("invalid_features")
    )
