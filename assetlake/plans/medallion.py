"""Raw -> cleaned -> features jobs and the batch ETL job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.text import surrogate_key
from assetlake.operators import features as feat
from assetlake.operators import validation as val
from assetlake.operators.ordering import recent_rows
from assetlake.operators.tables import first_per_key
from assetlake.session import cut_lineage

MEASURES = tuple(r.column for r in val.EQUIPMENT_RULES)

# Z-score column of every measure.
NORMALIZED_NAMES = {
    "air_temperature_k": "air_temp_normalized",
    "process_temperature_k": "process_temp_normalized",
    "rotational_speed_rpm": "rotational_speed_normalized",
    "torque_nm": "torque_normalized",
    "tool_wear_min": "tool_wear_normalized",
}


def clean_and_validate(raw: DataFrame, batch_id: str | None = None, order_by: Sequence[str] = ("id",)) -> DataFrame:
    """Keep the first record per udi (whole-table runs), check ranges, flag validity and collect errors."""
    rows = first_per_key(raw, ["udi"], order_by) if batch_id is None else val.filter_batch(raw, batch_id)
    flagged = rows.withColumns({**val.validity_columns(), "validation_errors": val.error_object()})
    flagged = flagged.withColumn("equipment_id", surrogate_key("udi", "product_id"))
    return val.null_out_of_range(flagged)


def cleaning_audit(cleaned: DataFrame, started: Column, finished: Column) -> DataFrame:
    """One audit row of a cleaning run."""
    return cleaned.agg(
        F.to_date(started).alias("cleaning_date"),
        F.count(F.lit(1)).alias("records_processed"),
        F.count(F.when(F.col("is_valid"), 1)).alias("records_validated"),
        F.count(F.when(~F.col("is_valid"), 1)).alias("records_invalidated"),
        F.lit('{"remove_duplicates": true, "validate_ranges": true, "handle_missing": "impute"}').alias("cleaning_rules"),
        (finished - started).alias("cleaning_duration"),
    )


def next_feature_version(features: DataFrame | None) -> Column:
    if features is None:
        return F.lit(1)
    return F.coalesce(features.agg(F.max("feature_version")).scalar(), F.lit(0)) + 1


def generate_features(
    cleaned: DataFrame,
    feature_date: Column,
    version: Column,
    rolling_keys: Sequence[str] = ("equipment_type",),
    order_by: Sequence[str] = ("timestamp", "udi"),
) -> DataFrame:
    """Encoded, z-scored, engineered and rolling features of the valid records.

    Statistics cover the whole cleaned table; rolling columns cover the last ten records per key. ``cleaned``
    is read several times: pass a stored or checkpointed table.
    """
    statistics = feat.scale_statistics(cleaned, MEASURES, 1)
    valid = cleaned.filter("is_valid")
    scaled = feat.apply_scaling(valid, statistics, MEASURES, "_z")
    engineered = scaled.withColumns({**feat.engineered_columns(), **feat.category_columns()})

    def rolling(w):
        frame = w.rowsBetween(-9, 0)
        return {
            "rolling_mean_torque_10": F.avg("torque_nm").over(frame),
            "rolling_std_torque_10": F.stddev_samp("torque_nm").over(frame),
            "rolling_mean_temp_diff_10": F.avg("temperature_difference").over(frame),
            "rolling_std_temp_diff_10": F.stddev_samp("temperature_difference").over(frame),
        }

    rolled = recent_rows(engineered, rolling_keys, order_by, 9, ["torque_nm", "temperature_difference"], rolling)
    return rolled.select(
        "equipment_id",
        feature_date.alias("feature_date"),
        "equipment_type_encoded",
        *[F.col(f"{m}_z").alias(n) for m, n in NORMALIZED_NAMES.items()],
        "temperature_difference",
        "torque_speed_ratio",
        "power_estimate",
        "wear_category",
        "rolling_mean_torque_10",
        "rolling_std_torque_10",
        "rolling_mean_temp_diff_10",
        "rolling_std_temp_diff_10",
        F.col("target").alias("failure_target"),
        F.when(F.col("target") == 1, F.lit(0.85)).otherwise(F.lit(0.15)).alias("failure_probability"),
        version.alias("feature_version"),
        F.lit(True).alias("is_active"),
    )


def etl_clean(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop duplicate rows, fill medians, drop quartile-fence outliers column by column.

    Every later step reads the distinct rows several times, so they are checkpointed once.
    """
    return feat.drop_iqr_outliers(feat.impute_medians(cut_lineage(raw.dropDuplicates()), columns), columns)


def etl_features(
    cleaned: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str], ts_col: str, window: int = 3
) -> DataFrame:
    """Calendar columns, rolling statistics per key and standard scaling of all resulting numbers."""
    timed = cleaned.withColumns(
        {k: v for k, v in feat.calendar_columns(ts_col).items() if k != "is_weekend"}
    )
    rolled = feat.rolling_features(timed, keys, order_by, columns, window)
    scaled = [*columns, "hour", "day_of_week", "month"]
    scaled += [f"{c}_{kind}" for c in columns for kind in ("rolling_mean", "rolling_std", "trend")]
    return feat.standard_scale(rolled, scaled)
