"""Typed schemas of the layered tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "interval": T.DayTimeIntervalType(),
    "dates": T.ArrayType(T.DateType()),
    "features": T.MapType(T.StringType(), T.DoubleType()),
}


def _field(text: str) -> T.StructField:
    name, kind = text.split(":")
    required = name.endswith("!")
    data_type = _TYPES.get(kind)
    if data_type is None:
        precision, scale = kind.removeprefix("decimal").split(".")
        data_type = T.DecimalType(int(precision), int(scale))
    return T.StructField(name.rstrip("!"), data_type, not required)


def schema(*lines: str) -> T.StructType:
    """``name:type`` words; ``!`` marks a required column, ``decimal8.2`` a decimal."""
    return T.StructType([_field(word) for line in lines for word in line.split()])


# Columns and types of the layered tables.
RAW_EQUIPMENT = schema(
    "id:long udi!:string product_id!:string equipment_type!:string air_temperature_k:decimal8.2",
    "process_temperature_k:decimal8.2 rotational_speed_rpm:int torque_nm:decimal8.2 tool_wear_min:int target:int",
    "failure_type:string timestamp:timestamp source_system:string batch_id:string raw_data:string",
    "created_at:timestamp updated_at:timestamp",
)
DATA_IMPORTS = schema(
    "run_id!:string file_name:string file_size:long records_count:long status:string error_message:string",
    "started_at:timestamp completed_at:timestamp created_by:string",
)
CLEANED_EQUIPMENT = schema(
    "equipment_id!:string udi!:string product_id!:string equipment_type!:string air_temperature_k:decimal8.2",
    "process_temperature_k:decimal8.2 rotational_speed_rpm:int torque_nm:decimal8.2 tool_wear_min:int target:int",
    "failure_type:string timestamp:timestamp is_valid:boolean passes_rules:boolean validation_errors:string",
    "cleaning_version:int cleaned_at:timestamp created_at:timestamp updated_at:timestamp",
)
CLEANING_HISTORY = schema(
    "cleaning_date:date records_processed:long records_validated:long records_invalidated:long",
    "cleaning_rules:string cleaning_duration:interval",
)
EQUIPMENT_FEATURES = schema(
    "equipment_id!:string feature_date!:date equipment_type_encoded:int air_temp_normalized:double",
    "process_temp_normalized:double rotational_speed_normalized:double torque_normalized:double",
    "tool_wear_normalized:double temperature_difference:double torque_speed_ratio:double power_estimate:double",
    "wear_category:string rolling_mean_torque_10:double rolling_std_torque_10:double",
    "rolling_mean_temp_diff_10:double rolling_std_temp_diff_10:double failure_target:int",
    "failure_probability:double feature_version:int is_active:boolean generated_at:timestamp",
)
FEATURE_METADATA = schema(
    "feature_name!:string feature_description:string feature_type:string source_table:string",
    "calculation_logic:string created_at:timestamp updated_at:timestamp is_active:boolean",
)
MODEL_METADATA = schema(
    "model_id!:string model_name!:string model_version!:string model_type!:string model_path:string",
    "training_date:date features_used:string hyperparameters:string performance_metrics:string",
    "training_data_range:dates is_production:boolean is_active:boolean created_at:timestamp updated_at:timestamp",
)
PREDICTIONS = schema(
    "prediction_id!:string equipment_id!:string prediction_timestamp!:timestamp model_id!:string",
    "failure_probability!:double predicted_class!:int prediction_threshold:double actual_class:int",
    "is_correct:boolean shap_values:string inference_time_ms:double batch_id:string",
)
AB_TESTING = schema(
    "test_id!:string test_name:string control_model_id!:string treatment_model_id!:string start_date!:date",
    "end_date:date sample_size:int success_metric:string results:string is_active:boolean created_at:timestamp",
)
MODEL_METRICS = schema(
    "metric_date!:date model_id!:string metric_name!:string metric_value!:double metric_type:string",
    "calculation_window:string records_processed:long created_at:timestamp",
)
DATA_DRIFT = schema(
    "check_date!:date feature_name!:string drift_score!:double drift_threshold!:double is_drifted:boolean",
    "reference_distribution:string current_distribution:string created_at:timestamp",
)
ALERTS = schema(
    "alert_id!:string alert_type:string alert_severity:string alert_message:string equipment_id:string",
    "model_id:string alert_data:string is_resolved:boolean resolved_at:timestamp resolved_by:string",
    "created_at:timestamp",
)
EQUIPMENT = schema(
    "equipment_id!:string equipment_type:string manufacturer:string model:string serial_number:string",
    "installation_date:date location:string department:string status:string created_at:timestamp",
    "updated_at:timestamp metadata:string",
)
SENSOR_DATA = schema(
    "equipment_id!:string timestamp!:timestamp temperature:double vibration:double pressure:double",
    "rotation_speed:double power_consumption:double efficiency:double created_at:timestamp",
)
MAINTENANCE_LOGS = schema(
    "log_id:long equipment_id:string maintenance_type:string description:string performed_by:string",
    "performed_at:timestamp duration_minutes:int cost:decimal10.2 parts_used:string created_at:timestamp",
)
FEATURE_VALUES = schema(
    "equipment_id!:string feature_name!:string feature_value:double timestamp!:timestamp created_at:timestamp"
)
ONLINE_FEATURES = schema("equipment_id!:string features:features timestamp:timestamp ingestion_time:timestamp")
TRAINING_DATASETS = schema(
    "dataset_name!:string feature_list:string start_date:timestamp end_date:timestamp sample_count:long",
    "created_at:timestamp",
)

# database -> table -> (schema, partition column or None)
LAYERS = {
    "raw": {"equipment_data": (RAW_EQUIPMENT, None), "data_imports": (DATA_IMPORTS, None), "sensor_data": (SENSOR_DATA, None)},
    "cleaned": {"equipment_cleaned": (CLEANED_EQUIPMENT, None), "cleaning_history": (CLEANING_HISTORY, None), "equipment": (EQUIPMENT, None), "maintenance_logs": (MAINTENANCE_LOGS, None)},
    "features": {
        "equipment_features": (EQUIPMENT_FEATURES, "feature_date"),
        "feature_metadata": (FEATURE_METADATA, None),
        "feature_values": (FEATURE_VALUES, None),
        "online_features": (ONLINE_FEATURES, None),
        "training_datasets": (TRAINING_DATASETS, None),
    },
    "models": {"model_metadata": (MODEL_METADATA, None), "predictions": (PREDICTIONS, None), "ab_testing": (AB_TESTING, None)},
    "monitoring": {
        "model_metrics": (MODEL_METRICS, "metric_date"),
        "data_drift": (DATA_DRIFT, "check_date"),
        "alerts": (ALERTS, None),
    },
}

# source header -> column of the raw equipment file
RAW_HEADER = {
    "UDI": "udi",
    "Product ID": "product_id",
    "Type": "equipment_type",
    "Air temperature [K]": "air_temperature_k",
    "Process temperature [K]": "process_temperature_k",
    "Rotational speed [rpm]": "rotational_speed_rpm",
    "Torque [Nm]": "torque_nm",
    "Tool wear [min]": "tool_wear_min",
    "Target": "target",
    "Failure Type": "failure_type",
}
