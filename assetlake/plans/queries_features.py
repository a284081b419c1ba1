"""Queries of the scaling, cleaning, sequence and job operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import features as feat
from assetlake.operators import profiling, store
from assetlake.operators.joins import production_only
from assetlake.operators.ordering import row_numbers
from assetlake.plans import medallion
from assetlake.plans.registry import query
from assetlake.plans.views import EVENTS_NOW, LINES_NOW
from assetlake.session import cut_lineage

READING_ORDER = ["reading_time", "reading_id"]
_BY_ENTITY = "PARTITION BY equipment_id ORDER BY reading_time, reading_id"


def _readings(t):
    return t.readings.select("reading_id", "equipment_id", "sensor", "value", "reading_time")


@query(
    "w01_moving_average",
    f"""SELECT reading_id, avg(value) OVER ({_BY_ENTITY} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS moving_average
        FROM {{readings}}""",
    floats="moving_average",
    scale=5,
)
def w01(t):
    out = feat.moving_average(_readings(t), ["equipment_id"], READING_ORDER, "value", 10)
    return out.select("reading_id", "moving_average")


_R3 = f"({_BY_ENTITY} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query(
    "w02_w03_rolling_features",
    f"""SELECT reading_id, CASE WHEN count(value) OVER {_R3} = 3 THEN avg(value) OVER {_R3} END AS value_rolling_mean,
               CASE WHEN count(value) OVER {_R3} = 3 THEN stddev_samp(value) OVER {_R3} END AS value_rolling_std,
               value - lag(value, 3) OVER ({_BY_ENTITY}) AS value_trend
        FROM {{readings}}""",
    floats="value_rolling_mean value_rolling_std value_trend",
    scale=5,
)
def w02(t):
    out = feat.rolling_features(_readings(t), ["equipment_id"], READING_ORDER, ["value"], 3)
    return out.select("reading_id", "value_rolling_mean", "value_rolling_std", "value_trend")


@query(
    "w04_lag_features",
    f"""SELECT reading_id, lag(value, 1) OVER ({_BY_ENTITY}) AS target_lag_1,
               lag(value, 3) OVER ({_BY_ENTITY}) AS target_lag_3, lag(value, 7) OVER ({_BY_ENTITY}) AS target_lag_7
        FROM {{readings}}""",
    floats="target_lag_1 target_lag_3 target_lag_7",
)
def w04(t):
    out = feat.lag_features(_readings(t), ["equipment_id"], READING_ORDER, "value")
    return out.select("reading_id", "target_lag_1", "target_lag_3", "target_lag_7")


@query(
    "w05_metric_change",
    f"""SELECT model_id, metric_date, metric_name, metric_value,
               lag(metric_value) OVER (PARTITION BY model_id, metric_name ORDER BY metric_date) AS previous_value,
               metric_value - lag(metric_value) OVER (PARTITION BY model_id, metric_name ORDER BY metric_date) AS change
        FROM {{model_metrics}} WHERE model_id IN (SELECT model_id FROM {{models}} WHERE is_production)
          AND metric_date >= DATE '{LINES_NOW[:10]}' - INTERVAL '30' DAY""",
    floats="metric_value previous_value change",
    dates="metric_date",
    scale=9,
)
def w05(t):
    first = F.date_sub(F.lit(LINES_NOW[:10]).cast("date"), 30)
    recent = production_only(t.model_metrics.filter(F.col("metric_date") >= first), t.models)
    return feat.change_from_previous(cut_lineage(recent), ["model_id", "metric_name"], ["metric_date"], "metric_value")


@query(
    "w07_row_number",
    f"SELECT reading_id, row_number() OVER ({_BY_ENTITY}) AS rn FROM {{readings}}",
)
def w07(t):
    return row_numbers(_readings(t), READING_ORDER, ["equipment_id"]).select("reading_id", "rn")


_R10 = f"({_BY_ENTITY} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(
    "w11_history_features",
    f"""SELECT reading_id, CASE WHEN count(*) OVER {_R10} >= 3 THEN avg(value) OVER {_R3} END AS value_rolling_mean_3,
               CASE WHEN count(*) OVER {_R10} >= 3 THEN value - first_value(value) OVER {_R10} END AS value_trend
        FROM {{readings}}""",
    floats="value_rolling_mean_3 value_trend",
    scale=5,
)
def w11(t):
    out = feat.history_features(_readings(t), ["equipment_id"], READING_ORDER, ["value"])
    return out.select("reading_id", "value_rolling_mean_3", "value_trend")


@query(
    "w12_rolling_pair",
    f"""SELECT reading_id, avg(value) OVER {_R10} AS rolling_mean_value_10,
               stddev_samp(value) OVER {_R10} AS rolling_std_value_10 FROM {{readings}}""",
    floats="rolling_mean_value_10 rolling_std_value_10",
    scale=5,
)
def w12(t):
    out = feat.rolling_pair(_readings(t), ["equipment_id"], READING_ORDER, ["value"], 10)
    return out.select("reading_id", "rolling_mean_value_10", "rolling_std_value_10")


@query(
    "w13_sigma_outliers",
    """SELECT r.reading_id, coalesce(s.std > 0 AND abs(r.value - s.mean) > 3 * s.std, false) AS is_anomaly
       FROM {readings} r JOIN (SELECT sensor, avg(value) AS mean, stddev_samp(value) AS std FROM {readings}
                               GROUP BY sensor) s ON r.sensor = s.sensor""",
)
def w13(t):
    return feat.sigma_outliers(_readings(t), ["sensor"], "value").select("reading_id", "is_anomaly")


@query(
    "w14_history_anomalies",
    """SELECT r.reading_id, r.equipment_id, r.sensor, r.value
       FROM {readings} r JOIN (SELECT equipment_id, sensor, quantile_cont(value, 0.25) AS q1,
                quantile_cont(value, 0.75) AS q3, count(*) AS n FROM {readings} GROUP BY equipment_id, sensor) q
         ON r.equipment_id = q.equipment_id AND r.sensor = q.sensor
       WHERE n >= 3 AND (r.value < q1 - 1.5 * (q3 - q1) OR r.value > q3 + 1.5 * (q3 - q1))""",
    floats="value",
)
def w14(t):
    marked = feat.history_anomalies(_readings(t), ["equipment_id", "sensor"], "value")
    return marked.filter("is_anomaly").select("reading_id", "equipment_id", "sensor", "value")


@query(
    "w15_equipment_age",
    f"""SELECT equipment_id, min(reading_time) AS first_record,
               date_diff('day', CAST(min(reading_time) AS DATE), DATE '{EVENTS_NOW[:10]}') AS age_days
        FROM {{readings}} GROUP BY equipment_id""",
    times="first_record",
)
def w15(t):
    ages = feat.entity_age(t.readings, "equipment_id", "reading_time", F.lit(EVENTS_NOW).cast("timestamp_ntz"))
    return ages.select("equipment_id", "first_record", F.col("age_days").cast("long").alias("age_days"))


# --- scaling and cleaning --------------------------------------------------------------------------------

_LINE_ID = "l_orderkey, l_linenumber, l_extendedprice"


@query(
    "a20_median_imputation",
    """SELECT udi, id, coalesce(torque_nm, (SELECT quantile_cont(torque_nm, 0.5) FROM {raw_equipment})) AS torque_nm
       FROM {raw_equipment}""",
    floats="id torque_nm",
)
def a20(t):
    return feat.impute_medians(t.raw_equipment, ["torque_nm"]).select("udi", "id", "torque_nm")


_FENCED = """
    f1 AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {readings}),
    s1 AS (SELECT r.* FROM {readings} r, f1 WHERE NOT (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))),
    f2 AS (SELECT quantile_cont(CAST(reading_id AS DOUBLE), 0.25) AS q1,
                  quantile_cont(CAST(reading_id AS DOUBLE), 0.75) AS q3 FROM s1)"""


@query(
    "a21_iqr_outlier_removal",
    f"""WITH {_FENCED} SELECT s1.reading_id, s1.value FROM s1, f2
        WHERE NOT (reading_id < q1 - 1.5 * (q3 - q1) OR reading_id > q3 + 1.5 * (q3 - q1))""",
    floats="value",
)
def a21(t):
    return feat.drop_iqr_outliers(_readings(t), ["value", "reading_id"]).select("reading_id", "value")


@query(
    "a22_z_score",
    f"""SELECT {_LINE_ID}, (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS l_quantity_normalized,
               (l_tax - avg(l_tax) OVER ()) / stddev_samp(l_tax) OVER () AS l_tax_normalized
        FROM {{lineitem}}""",
    floats="l_extendedprice l_quantity_normalized l_tax_normalized",
)
def a22(t):
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax")
    return feat.z_score(source, ["l_quantity", "l_tax"]).drop("l_quantity", "l_tax")


@query(
    "a23_standard_scaling",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, (l_quantity - m) / s AS l_quantity
       FROM {lineitem}, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM {lineitem}
                         WHERE l_linestatus = 'F') f
       WHERE l_linestatus = 'O'""",
    floats="l_extendedprice l_quantity",
)
def a23(t):
    source = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_linestatus")
    train, test = source.filter("l_linestatus = 'F'"), source.filter("l_linestatus = 'O'")
    return feat.standard_scale(train, ["l_quantity"], test).drop("l_linestatus")


@query(
    "a24_linear_trend",
    f"""SELECT equipment_id, sensor, regr_slope(value, day_number) AS slope,
               regr_intercept(value, day_number) AS intercept, count(*) AS points
        FROM (SELECT *, row_number() OVER (PARTITION BY equipment_id, sensor ORDER BY reading_time, reading_id)
                     AS day_number
              FROM {{readings}} WHERE reading_time >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL '7' DAY) d
        GROUP BY equipment_id, sensor""",
    floats="slope intercept",
    scale=9,
)
def a24(t):
    since = F.col("reading_time") >= F.lit(EVENTS_NOW).cast("timestamp_ntz") - F.expr("INTERVAL '7' DAY")
    return feat.linear_trend(_readings(t), ["equipment_id", "sensor"], READING_ORDER, "value", since)


# --- jobs ------------------------------------------------------------------------------------------------

_FIRST = "(SELECT *, row_number() OVER (PARTITION BY udi ORDER BY id) AS rn FROM {raw_equipment})"
_CLEAN = """
    SELECT md5(concat(udi, product_id)) AS equipment_id, udi, equipment_type, timestamp, target,
           CASE WHEN air_temperature_k BETWEEN 290 AND 310 THEN air_temperature_k END AS air_temperature_k,
           CASE WHEN process_temperature_k BETWEEN 305 AND 320 THEN process_temperature_k END AS process_temperature_k,
           CASE WHEN rotational_speed_rpm BETWEEN 1000 AND 3000 THEN rotational_speed_rpm END AS rotational_speed_rpm,
           CASE WHEN torque_nm BETWEEN 0 AND 100 THEN torque_nm END AS torque_nm,
           CASE WHEN tool_wear_min BETWEEN 0 AND 300 THEN tool_wear_min END AS tool_wear_min,
           torque_nm IS NOT NULL AS is_valid
    FROM """ + _FIRST + " r WHERE rn = 1"


@query(
    "m22_clean_and_validate",
    "SELECT equipment_id, udi, air_temperature_k, process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min, "
    f"is_valid FROM ({_CLEAN}) c",
    floats="air_temperature_k process_temperature_k rotational_speed_rpm torque_nm tool_wear_min",
)
def m22(t):
    return medallion.clean_and_validate(t.raw_equipment).select(
        "equipment_id", "udi", "air_temperature_k", "process_temperature_k", "rotational_speed_rpm", "torque_nm",
        "tool_wear_min", "is_valid",
    )


@query(
    "a44_cleaning_audit",
    f"""SELECT count(*) AS records_processed, count(CASE WHEN is_valid THEN 1 END) AS records_validated,
               count(CASE WHEN NOT is_valid THEN 1 END) AS records_invalidated FROM ({_CLEAN}) c""",
)
def a44(t):
    now = F.lit(EVENTS_NOW).cast("timestamp_ntz")
    audit = medallion.cleaning_audit(medallion.clean_and_validate(t.raw_equipment), now, now)
    return audit.select("records_processed", "records_validated", "records_invalidated")


_W10 = "(PARTITION BY equipment_type ORDER BY timestamp, udi ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(
    "m17_generate_features",
    f"""WITH c AS ({_CLEAN}),
        s AS (SELECT avg(air_temperature_k) AS ma, stddev_samp(air_temperature_k) AS sa, avg(torque_nm) AS mt,
                     stddev_samp(torque_nm) AS st, avg(tool_wear_min) AS mw, stddev_samp(tool_wear_min) AS sw FROM c)
        SELECT equipment_id, CASE equipment_type WHEN 'M' THEN 1 WHEN 'H' THEN 2 ELSE 0 END AS equipment_type_encoded,
               (air_temperature_k - ma) / sa AS air_temp_normalized, (torque_nm - mt) / st AS torque_normalized,
               (tool_wear_min - mw) / sw AS tool_wear_normalized,
               process_temperature_k - air_temperature_k AS temperature_difference,
               torque_nm * rotational_speed_rpm / 9549.3 AS power_estimate,
               CASE WHEN tool_wear_min < 50 THEN 'low' WHEN tool_wear_min <= 150 THEN 'medium'
                    WHEN tool_wear_min > 150 THEN 'high' ELSE 'unknown' END AS wear_category,
               avg(torque_nm) OVER {_W10} AS rolling_mean_torque_10,
               stddev_samp(process_temperature_k - air_temperature_k) OVER {_W10} AS rolling_std_temp_diff_10,
               target AS failure_target, 1 AS feature_version
        FROM c, s WHERE is_valid""",
    floats="air_temp_normalized torque_normalized tool_wear_normalized temperature_difference power_estimate "
    "rolling_mean_torque_10 rolling_std_temp_diff_10",
    scale=5,
)
def m17(t):
    cleaned = cut_lineage(medallion.clean_and_validate(t.raw_equipment))
    made = medallion.generate_features(
        cleaned, F.lit("2001-06-01").cast("date"), medallion.next_feature_version(None)
    )
    return made.select(
        "equipment_id", "equipment_type_encoded", "air_temp_normalized", "torque_normalized", "tool_wear_normalized",
        "temperature_difference", "power_estimate", "wear_category", "rolling_mean_torque_10",
        "rolling_std_temp_diff_10", "failure_target", "feature_version",
    )


_ETL = """
    d AS (SELECT DISTINCT equipment_id, reading_time, reading_id, value FROM {readings}),
    f1 AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM d),
    k AS (SELECT d.* FROM d, f1 WHERE NOT (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))),
    r AS (SELECT reading_id, value, CAST(hour(reading_time) AS DOUBLE) AS hour,
                 CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END AS rm,
                 CASE WHEN count(value) OVER w = 3 THEN stddev_samp(value) OVER w END AS rs,
                 value - lag(value, 3) OVER (PARTITION BY equipment_id ORDER BY reading_time, reading_id) AS tr
          FROM k WINDOW w AS (PARTITION BY equipment_id ORDER BY reading_time, reading_id
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@query(
    "m23_batch_etl",
    f"""WITH {_ETL} SELECT reading_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value,
               (hour - avg(hour) OVER ()) / stddev_pop(hour) OVER () AS hour,
               (rm - avg(rm) OVER ()) / stddev_pop(rm) OVER () AS value_rolling_mean,
               (rs - avg(rs) OVER ()) / stddev_pop(rs) OVER () AS value_rolling_std,
               (tr - avg(tr) OVER ()) / stddev_pop(tr) OVER () AS value_trend FROM r""",
    floats="value hour value_rolling_mean value_rolling_std value_trend",
    scale=5,
)
def m23(t):
    raw = t.readings.select("equipment_id", "reading_time", "reading_id", "value")
    cleaned = medallion.etl_clean(raw, ["value"])
    made = medallion.etl_features(cleaned, ["equipment_id"], READING_ORDER, ["value"], "reading_time")
    return made.select("reading_id", "value", "hour", "value_rolling_mean", "value_rolling_std", "value_trend")


@query(
    "m16_declared_transformations",
    """SELECT reading_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value_scaled,
              (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS value_minmax,
              ln(1 + value) AS value_log,
              CASE WHEN value < 10 THEN 0 WHEN value < 50 THEN 1 ELSE 2 END AS value_bin,
              CASE WHEN sensor = 'click' THEN 1 ELSE 0 END AS sensor_click,
              CASE WHEN sensor = 'view' THEN 1 ELSE 0 END AS sensor_view FROM {readings}""",
    floats="value_scaled value_minmax value_log",
)
def m16(t):
    plan = {
        "value": ["standard_scaler", "min_max_scaler", "log_transform", "binning"],
        "sensor": ["one_hot_encoding"],
    }
    out = store.apply_transformations(_readings(t), plan, {"sensor": ["click", "view"]}, {"value": [0.0, 10.0, 50.0, 1e9]})
    return out.select(
        "reading_id", "value_scaled", "value_minmax", "value_log", "value_bin", "sensor_click", "sensor_view"
    )


@query(
    "u02_drop_duplicate_rows",
    "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM {lineitem}",
)
def u02(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query(
    "a04_dataset_profile",
    """SELECT count(*) AS total_rows, 4 AS total_columns,
              CAST(sum(CASE WHEN torque_nm IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values,
              CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT udi, torque_nm, tool_wear_min, target
                                                     FROM {raw_equipment}) x) AS BIGINT) AS duplicates,
              3 AS numeric_columns, 1 AS categorical_columns
       FROM {raw_equipment}""",
)
def a04(t):
    return profiling.dataset_profile(t.raw_equipment.select("udi", "torque_nm", "tool_wear_min", "target"))
