"""Queries of the projection, rule and scalar-function operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.functions import numeric, text, tiers
from assetlake.operators import features as feat
from assetlake.operators import joins, store
from assetlake.operators import validation as val
from assetlake.plans.registry import query
from assetlake.plans.views import EVENTS_NOW

RAW_KEYS = "udi, id"

_MASKS = """
    CASE WHEN air_temperature_k >= 290 AND air_temperature_k <= 310 THEN air_temperature_k END AS air_temperature_k,
    CASE WHEN process_temperature_k >= 305 AND process_temperature_k <= 320 THEN process_temperature_k END
        AS process_temperature_k,
    CASE WHEN rotational_speed_rpm >= 1000 AND rotational_speed_rpm <= 3000 THEN rotational_speed_rpm END
        AS rotational_speed_rpm,
    CASE WHEN torque_nm >= 0 AND torque_nm <= 100 THEN torque_nm END AS torque_nm,
    CASE WHEN tool_wear_min >= 0 AND tool_wear_min <= 300 THEN tool_wear_min END AS tool_wear_min"""

_MEASURES = "air_temperature_k process_temperature_k rotational_speed_rpm torque_nm tool_wear_min"


@query("p01_null_out_of_range", f"SELECT {RAW_KEYS}, {_MASKS} FROM {{raw_equipment}}", floats="id " + _MEASURES)
def p01(t):
    return val.null_out_of_range(t.raw_equipment).select("udi", "id", *_MEASURES.split())


_RANGES_OK = """coalesce(air_temperature_k BETWEEN 290 AND 310 AND process_temperature_k BETWEEN 305 AND 320
    AND rotational_speed_rpm BETWEEN 1000 AND 3000 AND torque_nm BETWEEN 0 AND 100
    AND tool_wear_min BETWEEN 0 AND 300, false)"""


@query(
    "p02_validity_flags",
    f"""SELECT {RAW_KEYS}, torque_nm IS NOT NULL AND air_temperature_k IS NOT NULL AS is_valid,
        {_RANGES_OK} AS passes_rules FROM {{raw_equipment}}""",
    floats="id",
)
def p02(t):
    return t.raw_equipment.withColumns(val.validity_columns()).select("udi", "id", "is_valid", "passes_rules")


def _flag(column, low, high, name):
    broken = f"({column} < {low} OR {column} > {high})"
    return f"""'"{name}":', CASE WHEN {broken} THEN 'true' WHEN NOT {broken} THEN 'false' ELSE 'null' END"""


_ERRORS = ", ',', ".join(_flag(r.column, r.low, r.high, r.flag) for r in val.EQUIPMENT_RULES)


@query(
    "p03_error_object",
    f"SELECT {RAW_KEYS}, concat('{{{{', {_ERRORS}, '}}}}') AS validation_errors FROM {{raw_equipment}}",
    floats="id",
)
def p03(t):
    return t.raw_equipment.select("udi", "id", val.error_object().alias("validation_errors"))


@query(
    "p04_batch_filter",
    "SELECT 'O' AS batch, count(*) AS n FROM {raw_equipment} WHERE batch_id = 'O' "
    "UNION ALL SELECT 'all', count(*) FROM {raw_equipment}",
)
def p04(t):
    def size(batch, label):
        return val.filter_batch(t.raw_equipment, batch).agg(F.lit(label).alias("batch"), F.count(F.lit(1)).alias("n"))

    return size("O", "O").unionByName(size(None, "all"))


_BROKEN = "\n".join(
    f"|| CASE WHEN {r.column} < {r.low} OR {r.column} > {r.high} THEN '{r.flag};' ELSE '' END"
    for r in val.EQUIPMENT_RULES
)


@query(
    "p05_quarantine_split",
    f"""SELECT broken, count(*) AS n, min(udi) AS first_udi
        FROM (SELECT udi, '' {_BROKEN} AS broken FROM {{raw_equipment}}) c GROUP BY broken""",
)
def p05(t):
    valid, rejected = val.split_by_rules(t.raw_equipment, val.EQUIPMENT_RULES)
    named = rejected.withColumn("broken", F.concat(F.array_join("broken_rules", ";"), F.lit(";")))
    both = valid.select("udi", F.lit("").alias("broken")).unionByName(named.select("udi", "broken"))
    return both.groupBy("broken").agg(F.count(F.lit(1)).alias("n"), F.min("udi").alias("first_udi"))


_SENSOR_REASONS = "\n".join(
    f"|| CASE WHEN {r.column} IS NULL THEN 'missing {r.column};' WHEN {r.column} < {r.low} OR {r.column} > {r.high} "
    f"THEN '{r.column} out of range;' ELSE '' END"
    for r in val.SENSOR_RULES
)


@query(
    "p06_sensor_message_validation",
    f"SELECT message_id, equipment_id, '' {_SENSOR_REASONS} AS reasons FROM {{sensor_messages}}",
)
def p06(t):
    reasons = F.array_join(F.transform(val.sensor_errors(), lambda r: F.concat(r, F.lit(";"))), "")
    return t.sensor_messages.select("message_id", "equipment_id", reasons.alias("reasons"))


@query(
    "p07_relationship_errors",
    """SELECT message_id, CASE WHEN temperature > 100 AND pressure < 50
              THEN 'High temperature with low pressure indicates sensor error;' ELSE '' END
           || CASE WHEN vibration > 70 AND temperature < 60
              THEN 'High vibration with low temperature requires inspection;' ELSE '' END AS errors
       FROM {sensor_messages}
       WHERE (temperature > 100 AND pressure < 50) OR (vibration > 70 AND temperature < 60)""",
)
def p07(t):
    checked = t.sensor_messages.withColumn("e", val.relationship_errors()).filter(F.size("e") > 0)
    joined = F.array_join(F.transform("e", lambda r: F.concat(r, F.lit(";"))), "")
    return checked.select("message_id", joined.alias("errors"))


@query(
    "p08_relationship_warnings",
    """SELECT coalesce(pressure < 50 AND temperature <= 100, false) AS warned, count(*) AS n
       FROM {sensor_messages} GROUP BY 1""",
)
def p08(t):
    warned = (F.size(val.relationship_warnings()) > 0).alias("warned")
    return t.sensor_messages.groupBy(warned).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p09_request_rules",
    f"""SELECT request_no, '' || CASE WHEN length(equipment_id) < 3 OR length(equipment_id) > 50 THEN 'id length;' ELSE '' END
          || CASE WHEN equipment_id LIKE 'EQ-%' OR equipment_id LIKE 'PUMP-%' OR equipment_id LIKE 'COMP-%'
                    OR equipment_id LIKE 'TURB-%' THEN '' ELSE 'id prefix;' END
          || CASE WHEN equipment_type IN ('pump', 'compressor', 'turbine', 'generator', 'conveyor') THEN ''
                  ELSE 'type;' END
          || CASE WHEN timestamp > TIMESTAMP '{EVENTS_NOW}' THEN 'future timestamp;' ELSE '' END
          || CASE WHEN timestamp < TIMESTAMP '{EVENTS_NOW}' - INTERVAL '7' DAY THEN 'too old;' ELSE '' END AS errors
        FROM {{requests}}""",
)
def p09(t):
    joined = F.array_join(F.transform(val.request_errors(EVENTS_NOW), lambda r: F.concat(r, F.lit(";"))), "")
    return t.requests.select("request_no", joined.alias("errors"))


@query(
    "p09_batch_size",
    "SELECT batch_id, count(*) AS requests, count(*) BETWEEN 1 AND 1000 AS size_ok FROM {requests} GROUP BY batch_id",
)
def p09b(t):
    return val.batch_size_check(t.requests)


@query(
    "p10_range_message",
    """SELECT message_id, CASE WHEN vibration < 20 THEN 'below' WHEN vibration > 80 THEN 'above' ELSE 'ok' END AS verdict
       FROM {sensor_messages}""",
)
def p10(t):
    message = val.range_message("vibration", 20, 80)
    verdict = (
        F.when(message.contains("less than minimum"), "below")
        .when(message.contains("greater than maximum"), "above")
        .otherwise("ok")
    )
    return t.sensor_messages.select("message_id", verdict.alias("verdict"))


# one definition per event type; 'signup' stays unregistered
READING_REGISTRY = (
    {"name": "click", "type": "numeric", "validation_rules": {"min": 1, "max": 100}},
    {"name": "view", "type": "numeric", "validation_rules": {"min": 0.5}},
    {"name": "purchase", "type": "numeric", "validation_rules": {"max": 200}},
    {"name": "error", "type": "categorical", "validation_rules": {"allowed_values": ["1.0", "2.5", "10.0"]}},
)

_REGISTRY_SQL = """
    CASE WHEN sensor NOT IN ('click', 'view', 'purchase', 'error') THEN 'Feature not found'
         WHEN (sensor = 'click' AND value < 1) OR (sensor = 'view' AND value < 0.5) THEN 'Value below minimum'
         WHEN (sensor = 'click' AND value > 100) OR (sensor = 'purchase' AND value > 200) THEN 'Value above maximum'
         WHEN sensor = 'error' AND value NOT IN (1.0, 2.5, 10.0) THEN 'Value not in allowed values' END"""


def _checked_readings(t):
    registry = store.registry_frame(t.spark, READING_REGISTRY)
    return val.validate_against_registry(t.readings, registry, "sensor", "value")


@query(
    "p11_registry_validation",
    f"SELECT reading_id, coalesce({_REGISTRY_SQL}, '') AS error FROM {{readings}}",
)
def p11(t):
    return _checked_readings(t).select("reading_id", F.coalesce("error", F.lit("")).alias("error"))


@query(
    "p11_entity_validity",
    f"""SELECT equipment_id, bool_and({_REGISTRY_SQL} IS NULL) AS all_valid,
               count(CASE WHEN {_REGISTRY_SQL} IS NOT NULL THEN 1 END) AS invalid_features
        FROM {{readings}} GROUP BY equipment_id""",
)
def p11b(t):
    return val.entity_validity(_checked_readings(t))


@query(
    "p12_engineered_arithmetic",
    """SELECT udi, id, process_temperature_k - air_temperature_k AS temperature_difference,
              CASE WHEN rotational_speed_rpm > 0 THEN torque_nm / rotational_speed_rpm ELSE 0 END AS torque_speed_ratio,
              torque_nm * rotational_speed_rpm / 9549.3 AS power_estimate,
              (process_temperature_k - air_temperature_k) * tool_wear_min AS temp_wear_interaction
       FROM {raw_equipment}""",
    floats="id temperature_difference torque_speed_ratio power_estimate temp_wear_interaction",
)
def p12(t):
    new = feat.engineered_columns()
    return t.raw_equipment.withColumns(new).select("udi", "id", *new)


@query(
    "p13_wear_category",
    """SELECT equipment_id, CASE WHEN tool_wear_min < 50 THEN 'low' WHEN tool_wear_min <= 150 THEN 'medium'
                                 ELSE 'high' END AS upper_inclusive,
              CASE WHEN tool_wear_min < 50 THEN 'low' WHEN tool_wear_min < 150 THEN 'medium' ELSE 'high' END
                  AS upper_exclusive
       FROM {equipment}""",
)
def p13(t):
    return t.equipment.select(
        "equipment_id",
        tiers.wear_category("tool_wear_min").alias("upper_inclusive"),
        tiers.wear_category("tool_wear_min", upper_inclusive=False).alias("upper_exclusive"),
    )


@query(
    "p14_decision_and_confidence",
    """SELECT prediction_id, CASE WHEN p >= 0.35 THEN 1 ELSE 0 END AS decision,
              CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS strict_decision,
              CASE WHEN p >= 0.35 THEN 'FAILURE' ELSE 'NORMAL' END AS label,
              CASE WHEN p >= 0.35 THEN p ELSE 1.0 - p END AS confidence
       FROM {predictions}""",
    floats="confidence",
)
def p14(t):
    decided = t.predictions.withColumn("decision", tiers.decide("p", 0.35))
    return decided.select(
        "prediction_id",
        "decision",
        tiers.decide("p", 0.5, strict=True).alias("strict_decision"),
        tiers.class_label("decision").alias("label"),
        tiers.confidence("p", "decision").alias("confidence"),
    )


@query(
    "p15_alert_and_recommendation",
    f"""SELECT prediction_id, CASE WHEN p >= 0.8 THEN 'critical' WHEN p >= 0.4 THEN 'warning' ELSE 'normal' END AS alert_level,
               CASE WHEN p >= 0.8 THEN '{tiers.RECOMMEND_REPAIR}' WHEN p >= 0.6 THEN '{tiers.RECOMMEND_SERVICE}'
                    WHEN p >= 0.4 THEN '{tiers.RECOMMEND_WATCH}' ELSE '{tiers.RECOMMEND_NONE}' END AS recommendation
        FROM {{predictions}}""",
)
def p15(t):
    return t.predictions.select(
        "prediction_id", tiers.alert_level("p").alias("alert_level"), tiers.recommendation("p").alias("recommendation")
    )


@query(
    "p16_three_tier_recommendation",
    f"""SELECT CASE WHEN p > 0.8 THEN '{tiers.SHORT_REPAIR}' WHEN p > 0.5 THEN '{tiers.SHORT_SERVICE}'
                    ELSE '{tiers.SHORT_NONE}' END AS recommendation, count(*) AS n
        FROM {{predictions}} GROUP BY 1""",
)
def p16(t):
    tier = tiers.recommendation_three_tier("p").alias("recommendation")
    return t.predictions.groupBy(tier).agg(F.count(F.lit(1)).alias("n"))


_RISK = "CASE WHEN p > 0.7 THEN 'CRITICAL' WHEN p > 0.5 THEN 'HIGH' WHEN p > 0.3 THEN 'MEDIUM' ELSE 'LOW' END"
_SCORE = "CASE WHEN predicted = 1 THEN CASE WHEN p > 0.7 THEN 100 WHEN p > 0.5 THEN 75 WHEN p > 0.3 THEN 50 ELSE 25 END ELSE 0 END"


@query(
    "p17_risk_category_and_score",
    f"SELECT prediction_id, {_RISK} AS risk_category, {_SCORE} AS risk_score FROM {{predictions}}",
)
def p17(t):
    return t.predictions.select(
        "prediction_id",
        tiers.risk_category("p").alias("risk_category"),
        tiers.risk_score("p", "predicted").alias("risk_score"),
    )


@query(
    "p19_calendar_features",
    """SELECT reading_id, CAST(hour(reading_time) AS INT) AS hour, CAST(isodow(reading_time) - 1 AS INT) AS day_of_week,
              CAST(month(reading_time) AS INT) AS month,
              CASE WHEN isodow(reading_time) >= 6 THEN 1 ELSE 0 END AS is_weekend
       FROM {readings}""",
)
def p19(t):
    new = feat.calendar_columns("reading_time")
    return t.readings.withColumns(new).select("reading_id", *new)


@query(
    "p20_sensor_ratios",
    """SELECT message_id, temperature / (pressure + 1e-10) AS temperature_pressure_ratio,
              vibration * vibration AS vibration_energy,
              rotation_speed / (power_consumption + 1e-10) AS efficiency,
              temperature / (vibration + 1e-10) AS temperature_vibration_ratio
       FROM {sensor_messages}""",
)
def p20(t):
    new = {**feat.sensor_ratio_columns(), **feat.simulator_ratio_columns(scale=None)}
    return t.sensor_messages.withColumns(new).select("message_id", *new)


@query(
    "p21_ordinal_encoding",
    """SELECT udi, id, CASE equipment_type WHEN 'L' THEN 0 WHEN 'M' THEN 1 WHEN 'H' THEN 2 ELSE 0 END
                  AS equipment_type_encoded,
              CASE WHEN tool_wear_min < 50 THEN 'low' WHEN tool_wear_min <= 150 THEN 'medium' ELSE 'high' END
                  AS wear_category,
              CASE WHEN tool_wear_min < 50 THEN 0 WHEN tool_wear_min <= 150 THEN 1 ELSE 2 END AS wear_category_encoded
       FROM {raw_equipment}""",
    floats="id",
)
def p21(t):
    new = feat.category_columns()
    return t.raw_equipment.withColumns(new).select("udi", "id", *new)


@query(
    "p22_one_hot",
    """SELECT udi, id, CASE WHEN equipment_type = 'L' THEN 1 ELSE 0 END AS "type_L",
              CASE WHEN equipment_type = 'M' THEN 1 ELSE 0 END AS "type_M",
              CASE WHEN equipment_type = 'H' THEN 1 ELSE 0 END AS "type_H"
       FROM {raw_equipment}""",
    floats="id",
)
def p22(t):
    new = feat.one_hot("equipment_type", ("L", "M", "H"), "type")
    return t.raw_equipment.withColumns(new).select("udi", "id", *new)


@query(
    "p23_binary_target",
    """SELECT failure_type, CASE WHEN failure_type = 'No Failure' THEN 0 ELSE 1 END AS failure_target, count(*) AS n
       FROM {raw_equipment} GROUP BY 1, 2""",
)
def p23(t):
    return t.raw_equipment.groupBy("failure_type", feat.binary_target().alias("failure_target")).agg(
        F.count(F.lit(1)).alias("n")
    )


_ERROR_TYPE = """CASE WHEN predicted = actual THEN 'Correct' WHEN predicted = 1 AND actual = 0 THEN 'False Positive'
    ELSE 'False Negative' END"""


@query("p24_error_type", f"SELECT prediction_id, {_ERROR_TYPE} AS error_type FROM {{predictions}}")
def p24(t):
    return t.predictions.select("prediction_id", tiers.error_type("predicted", "actual").alias("error_type"))


@query("p25_active_models", "SELECT model_id, model_name FROM {models} WHERE is_active")
def p25(t):
    return t.models.filter("is_active").select("model_id", "model_name")


@query(
    "p26_feature_projection",
    "SELECT air_temperature_k, process_temperature_k, torque_nm, target FROM {raw_equipment}",
    floats="air_temperature_k process_temperature_k torque_nm",
)
def p26(t):
    return feat.select_model_columns(
        t.raw_equipment, ["air_temperature_k", "process_temperature_k", "torque_nm"], "target"
    )


@query(
    "p27_clean_column_names",
    'SELECT l_quantity AS "Torque_Nm", l_discount AS "Air_temperature_K" FROM {lineitem}',
    floats="Torque_Nm Air_temperature_K",
)
def p27(t):
    source = t.lineitem.select(F.col("l_quantity").alias("Torque [Nm]"), F.col("l_discount").alias("Air temperature [K]"))
    return text.clean_column_names(source)


@query(
    "p28_feature_scan",
    """SELECT equipment_id, feature_name, feature_value, timestamp FROM {offline}
       WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
         AND feature_name IN ('click', 'view')""",
    floats="feature_value",
    times="timestamp",
)
def p28(t):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-20 00:00:00"))
    found = store.scan_features(t.offline, start, end, features=["click", "view"])
    return found.select("equipment_id", "feature_name", "feature_value", "timestamp")


@query(
    "p29_high_risk_filter",
    "SELECT prediction_id, p FROM {predictions} WHERE predicted = 1 AND p > 0.7",
    floats="p",
)
def p29(t):
    return t.predictions.filter("predicted = 1 AND p > 0.7").select("prediction_id", "p")


@query(
    "p30_prediction_correctness",
    """SELECT prediction_id, o.outcome AS actual, predicted = o.outcome AS is_correct
       FROM {predictions} p LEFT JOIN (SELECT CAST(o_orderkey AS STRING) AS batch_id,
            CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS outcome FROM {orders}) o ON p.batch_id = o.batch_id""",
)
def p30(t):
    outcomes = t.orders.select(
        F.col("o_orderkey").cast("string").alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("outcome"),
    )
    return joins.resolve_outcomes(t.predictions, outcomes, "batch_id").select("prediction_id", "actual", "is_correct")


# --- scalar functions ------------------------------------------------------------------------------------

_FORMATTED = """CASE WHEN {p} IS NULL THEN 'N/A' WHEN {p} < 0.001 THEN '<0.1%' WHEN {p} > 0.999 THEN '>99.9%'
    ELSE concat(CAST(CAST(CAST({p} * 100 AS DECIMAL(20,10)) AS DECIMAL(10,1)) AS VARCHAR), '%') END"""


@query(
    "f01_format_probability",
    "SELECT event_id, " + _FORMATTED.replace("{p}", "nullif(value / 100, 0.5)") + " AS shown FROM {events}",
)
def f01(t):
    return t.events.select("event_id", text.format_probability(F.expr("nullif(value / 100, 0.5)")).alias("shown"))


@query(
    "f02_format_equipment_type",
    """SELECT event_type, CASE WHEN upper(substr(event_type, 3, 1)) = 'L' THEN 'Low Quality'
                WHEN upper(substr(event_type, 3, 1)) = 'M' THEN 'Medium Quality'
                WHEN upper(substr(event_type, 3, 1)) = 'H' THEN 'High Quality' ELSE 'Unknown' END AS label,
              count(*) AS n FROM {events} GROUP BY 1, 2""",
)
def f02(t):
    code = F.upper(F.substring("event_type", 3, 1))
    return t.events.groupBy("event_type", text.format_equipment_type(code).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "z02_sql_functions",
    "SELECT equipment_type, 'Low Quality' AS label, "
    + _FORMATTED.replace("{p}", "max(torque_nm) / 1000")
    + " AS shown FROM {raw_equipment} WHERE equipment_type = 'L' GROUP BY 1",
)
def z02(t):
    text.register_sql_functions(t.spark)
    return t.spark.sql(
        """SELECT equipment_type, format_equipment_type(equipment_type) AS label,
                  format_probability(max(torque_nm) / 1000) AS shown
           FROM {raw} WHERE equipment_type = 'L' GROUP BY equipment_type""",
        raw=t.raw_equipment,
    )


@query("f03_surrogate_key", "SELECT udi, id, md5(concat(udi, product_id)) AS equipment_id FROM {raw_equipment}", floats="id")
def f03(t):
    return t.raw_equipment.select("udi", "id", text.surrogate_key("udi", "product_id").alias("equipment_id"))


@query(
    "f04_json_member",
    "SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.none'), '-') AS none FROM {events}",
)
def f04(t):
    return t.events.select(
        "event_id",
        text.json_text("props", "k").alias("k"),
        F.coalesce(text.json_text("props", "none"), F.lit("-")).alias("none"),
    )


@query(
    "f05_json_object",
    """SELECT event_id, concat('{{"user":', CAST(user_id AS VARCHAR), ',"type":"', event_type, '","missing":null}}') AS doc
       FROM {events}""",
)
def f05(t):
    doc = text.json_object(
        F.col("user_id").alias("user"), F.col("event_type").alias("type"), F.lit(None).cast("string").alias("missing")
    )
    return t.events.select("event_id", doc.alias("doc"))


@query(
    "f06_date_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) - INTERVAL '30' DAY AS month_before,
              date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age_days,
              date_diff('second', o_orderdate, TIMESTAMP '2001-08-02 00:00:00') AS age_seconds
       FROM {orders}""",
    dates="day month_before",
)
def f06(t):
    now = F.lit("2001-08-02 00:00:00").cast("timestamp_ntz")
    return t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.date_sub(F.to_date("o_orderdate"), 30).alias("month_before"),
        F.datediff(now, "o_orderdate").cast("long").alias("age_days"),
        F.timestamp_diff("SECOND", F.col("o_orderdate"), now).alias("age_seconds"),
    )


@query(
    "f07_parse_iso",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed, event_type <> 'error' AS readable FROM {events}""",
)
def f07(t):
    written = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    )
    parsed = text.parse_iso(written)
    # print the instant in UTC whatever the session's zone
    shown = F.date_format(F.to_utc_timestamp(parsed, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", shown.alias("parsed"), parsed.isNotNull().alias("readable"))


@query(
    "f08_null_and_zero_guards",
    """SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS type_or_none, least(value, 50.0) AS capped,
              value / nullif(user_id, 0) AS per_user FROM {events}""",
    floats="capped per_user",
    scale=12,
)
def f08(t):
    return t.events.select(
        "event_id",
        F.coalesce(F.nullif(F.col("event_type"), F.lit("view")), F.lit("none")).alias("type_or_none"),
        F.least(F.col("value"), F.lit(50.0)).alias("capped"),
        numeric.safe_divide("value", "user_id").alias("per_user"),
    )


@query(
    "f09_rounding",
    """SELECT l_quantity, round(l_quantity / 2) AS half_up, round_even(l_quantity / 2, 0) AS half_even, count(*) AS n
       FROM {lineitem} GROUP BY 1, 2, 3""",
    floats="l_quantity half_up half_even",
)
def f09(t):
    half = F.col("l_quantity") / 2
    return t.lineitem.groupBy(
        "l_quantity", numeric.round_half_up(half, 0).alias("half_up"), numeric.round_half_even(half, 0).alias("half_even")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f10_width_bucket",
    """SELECT CASE WHEN value < 10 THEN 0 WHEN value >= 110 THEN 11 ELSE CAST(floor((value - 10) / 10) AS BIGINT) + 1 END
                  AS bucket, count(*) AS n FROM {events} GROUP BY 1""",
)
def f10(t):
    bucket = numeric.equal_width_bucket("value", 10, 110, 10).alias("bucket")
    return t.events.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query("f11_log_and_power", "SELECT event_id, CASE WHEN value > 0 THEN ln(value) END AS log_value, value * value AS energy FROM {events}", floats="log_value energy")
def f11(t):
    return t.events.select("event_id", F.ln("value").alias("log_value"), F.pow("value", F.lit(2.0)).alias("energy"))


@query(
    "f12_numeric_cast_default",
    """SELECT o_orderkey, coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) || CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE '' END
              AS DOUBLE), 0.0) AS level FROM {orders}""",
    floats="level",
)
def f12(t):
    written = F.concat(
        F.substring("o_orderpriority", 1, 1), F.when(F.col("o_orderstatus") == "F", F.lit("x")).otherwise(F.lit(""))
    )
    return t.orders.select("o_orderkey", numeric.to_double(written).alias("level"))


@query(
    "f13_date_array",
    """SELECT training_date, CAST(training_date - INTERVAL '30' DAY AS DATE) AS range_start, training_date AS range_end,
              count(*) AS n FROM {models} GROUP BY 1, 2, 3""",
    dates="training_date range_start range_end",
)
def f13(t):
    span = text.date_range_array("training_date")
    return t.models.groupBy(
        "training_date", span[0].alias("range_start"), span[1].alias("range_end")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("f14_batch_item_ids", "SELECT batch_id, request_no, concat(batch_id, '_item_', CAST(request_no AS VARCHAR)) AS request_id FROM {requests}")
def f14(t):
    return t.requests.select("batch_id", "request_no", text.batch_item_id("batch_id", "request_no").alias("request_id"))


@query("f14_random_ids")
def f14b(t):
    return t.requests.select("request_no", text.random_id("req_").alias("request_id"))


@query(
    "j10_unknown_equipment",
    """SELECT r.equipment_id, r.request_no, 'not found' AS error FROM {requests} r
       WHERE NOT EXISTS (SELECT 1 FROM {equipment} e WHERE concat('EQ-', e.equipment_id) = r.equipment_id)""",
)
def j10(t):
    master = t.equipment.select(F.concat(F.lit("EQ-"), "equipment_id").alias("equipment_id"))
    return joins.unknown_entities(t.requests, master, "equipment_id").select("equipment_id", "request_no", "error")


@query(
    "p18_drift_severity",
    f"""SELECT check_date, feature_name, drift_score, drift_score > drift_threshold AS is_drifted,
               CASE WHEN drift_score > drift_threshold * 1.5 THEN 'HIGH' WHEN drift_score > drift_threshold THEN 'MEDIUM'
                    ELSE 'LOW' END AS drift_severity
        FROM {{data_drift}} WHERE check_date >= DATE '{EVENTS_NOW[:10]}' - INTERVAL '7' DAY""",
    floats="drift_score",
    dates="check_date",
)
def p18(t):
    from assetlake.operators.drift import drift_report

    since = F.date_sub(F.lit(EVENTS_NOW).cast("date"), 7)
    report = drift_report(t.data_drift, since)
    return report.select(
        "check_date",
        "feature_name",
        "drift_score",
        (F.col("drift_score") > F.col("drift_threshold")).alias("is_drifted"),
        "drift_severity",
    )


