"""Queries of the profile, report, join, ranking and table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import evaluation, joins, profiling, reports, tables
from assetlake.operators.features import entity_age
from assetlake.plans.registry import query
from assetlake.plans.views import LINES_NOW, ORDERS_NOW


def _now(text):
    return F.lit(text).cast("timestamp_ntz")


_RECENT = f"prediction_timestamp >= TIMESTAMP '{LINES_NOW}' - INTERVAL '30' DAY"
_PRODUCTION = "model_id IN (SELECT model_id FROM {models} WHERE is_production)"


def _recent(t):
    """Predictions of the last 30 days."""
    return t.predictions.filter(F.col("prediction_timestamp") >= reports.days_before(_now(LINES_NOW), 30))


@query(
    "a01_layer_statistics",
    """SELECT 'raw' AS layer, count(*) AS total_records, count(DISTINCT udi) AS unique_records,
              count(CASE WHEN udi IS NULL THEN 1 END) AS flagged_records, min(timestamp) AS earliest_record,
              max(timestamp) AS latest_record FROM {raw_equipment}
       UNION ALL SELECT 'cleaned', count(*), count(DISTINCT equipment_id), count(CASE WHEN NOT is_valid THEN 1 END),
              min(created_at), max(created_at) FROM {cleaned}
       UNION ALL SELECT 'features', count(*), count(DISTINCT equipment_id), count(CASE WHEN feature_value IS NULL THEN 1 END),
              min(timestamp), max(timestamp) FROM {offline}""",
    times="earliest_record latest_record",
)
def a01(t):
    return profiling.union_all(
        profiling.layer_statistics(t.raw_equipment, "raw", "udi", F.col("udi").isNull(), "timestamp"),
        profiling.layer_statistics(t.cleaned, "cleaned", "equipment_id", ~F.col("is_valid"), "created_at"),
        profiling.layer_statistics(t.offline, "features", "equipment_id", F.col("feature_value").isNull(), "timestamp"),
    )


@query(
    "a02_failure_distribution",
    """SELECT equipment_type, count(*) AS total_records, count(CASE WHEN target = 1 THEN 1 END) AS failure_count,
              round(100.0 * count(CASE WHEN target = 1 THEN 1 END) / count(*), 2) AS failure_rate_percent,
              avg(tool_wear_min) AS avg_tool_wear, avg(torque_nm) AS avg_torque
       FROM {cleaned} WHERE is_valid GROUP BY equipment_type""",
    floats="failure_rate_percent avg_tool_wear avg_torque",
)
def a02(t):
    return profiling.failure_distribution(t.cleaned)


_NULLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
        round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_percent FROM {{cleaned}}"""
    for c in ("air_temperature_k", "torque_nm", "tool_wear_min")
)


@query("a03_null_profile", _NULLS, floats="null_percent")
def a03(t):
    return profiling.null_profile(t.cleaned, ["air_temperature_k", "torque_nm", "tool_wear_min"])


@query(
    "a04_value_ranges",
    """SELECT 'air_temperature_k' AS column_name, min(air_temperature_k) AS min, max(air_temperature_k) AS max FROM {raw_equipment}
       UNION ALL SELECT 'torque_nm', min(torque_nm), max(torque_nm) FROM {raw_equipment}""",
    floats="min max",
)
def a04b(t):
    return profiling.value_ranges(t.raw_equipment, ["air_temperature_k", "torque_nm"])


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
        quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
        FROM {{lineitem}}"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")
)


@query("a15_describe", _DESCRIBE, floats="mean std min q25 q50 q75 max", scale=4)
def a15(t):
    return profiling.describe_columns(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


_CORR_COLUMNS = ("p", "actual", "quantity", "discount")
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS correlation FROM {{predictions}}"
    for i, a in enumerate(_CORR_COLUMNS)
    for b in _CORR_COLUMNS[i + 1 :]
)


@query("a16_correlation_pairs", _CORR, floats="correlation")
def a16(t):
    return profiling.correlation_pairs(t.predictions, _CORR_COLUMNS)


@query(
    "a16_strong_correlations",
    f"SELECT * FROM ({_CORR}) c WHERE abs(correlation) > 0.5",
    floats="correlation",
)
def a16b(t):
    return profiling.correlation_pairs(t.predictions, _CORR_COLUMNS, 0.5)


@query(
    "a17_value_shares",
    """SELECT failure_type, count(*) AS count, count(*) * 1.0 / (SELECT count(*) FROM {raw_equipment}) AS share
       FROM {raw_equipment} GROUP BY failure_type""",
    floats="share",
)
def a17(t):
    return profiling.value_shares(t.raw_equipment, "failure_type")


@query(
    "a18_grouped_summary",
    """SELECT equipment_type, count(target) AS count, round_even(avg(target), 3) AS mean, sum(target) AS sum
       FROM {raw_equipment} GROUP BY equipment_type""",
    floats="mean",
)
def a18(t):
    return profiling.grouped_summary(t.raw_equipment, "equipment_type")


_OUTLIERS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END)
            AS outlier_count,
        round(100.0 * count(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1 END) / count(*), 2)
            AS outlier_percent
        FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src}) f"""
    for c, src in (("value", "{readings}"), ("reading_id", "{readings}"))
)


@query("a19_outlier_profile", _OUTLIERS, floats="outlier_percent")
def a19(t):
    return profiling.outlier_profile(t.readings, ["value", "reading_id"])


@query(
    "a28_class_histogram",
    """SELECT target, bin, count, avg(class_mean) AS class_mean FROM (
         SELECT target, CASE WHEN air_temperature_k < 290 THEN 0 WHEN air_temperature_k >= 310 THEN 11
                        ELSE CAST(floor((air_temperature_k - 290) / 2) AS BIGINT) + 1 END AS bin,
                count(*) OVER (PARTITION BY target, CASE WHEN air_temperature_k < 290 THEN 0
                               WHEN air_temperature_k >= 310 THEN 11
                               ELSE CAST(floor((air_temperature_k - 290) / 2) AS BIGINT) + 1 END) AS count,
                avg(air_temperature_k) OVER (PARTITION BY target) AS class_mean
         FROM {raw_equipment}) h GROUP BY target, bin, count""",
    floats="class_mean",
)
def a28(t):
    return profiling.class_histogram(t.raw_equipment, "air_temperature_k", "target", 290, 310, 10)


@query(
    "a05_daily_prediction_statistics",
    f"""SELECT CAST(prediction_timestamp AS DATE) AS prediction_date, count(*) AS total_predictions,
               CAST(sum(predicted) AS BIGINT) AS positive_predictions, CAST(sum(actual) AS BIGINT) AS actual_failures,
               avg(failure_probability) AS avg_failure_probability, avg(inference_time_ms) AS avg_inference_time_ms
        FROM {{predictions}} WHERE prediction_timestamp >= TIMESTAMP '{LINES_NOW}' - INTERVAL '7' DAY AND {_PRODUCTION}
        GROUP BY 1""",
    floats="avg_failure_probability avg_inference_time_ms",
    dates="prediction_date",
)
def a05(t):
    return reports.daily_prediction_statistics(t.predictions, t.models, _now(LINES_NOW))


@query(
    "a06_confusion_matrix",
    f"""SELECT actual, count(CASE WHEN predicted = 0 THEN 1 END) AS predicted_0,
               count(CASE WHEN predicted = 1 THEN 1 END) AS predicted_1, count(*) AS total
        FROM {{predictions}} WHERE {_RECENT} AND {_PRODUCTION} GROUP BY actual""",
)
def a06(t):
    return evaluation.confusion_matrix(joins.production_only(_recent(t), t.models))


@query(
    "a07_economic_effect",
    f"""SELECT count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END) AS total_false_positives,
               count(CASE WHEN predicted = 0 AND actual = 1 THEN 1 END) AS total_false_negatives,
               count(CASE WHEN predicted = 1 AND actual = 1 THEN 1 END) AS total_true_positives,
               count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END) * 5000 AS fp_cost,
               count(CASE WHEN predicted = 0 AND actual = 1 THEN 1 END) * 15000 AS fn_cost,
               count(CASE WHEN predicted = 1 AND actual = 1 THEN 1 END) * 10000 AS tp_savings
        FROM {{predictions}} WHERE prediction_timestamp >= TIMESTAMP '{LINES_NOW}' - INTERVAL '30' DAY""",
)
def a07(t):
    return evaluation.economic_effect(_recent(t))


@query(
    "a08_pivot_metrics",
    """SELECT metric_date, max(CASE WHEN metric_name = 'recall' THEN metric_value END) AS recall,
              max(CASE WHEN metric_name = 'fpr' THEN metric_value END) AS fpr FROM {daily_metrics} GROUP BY metric_date""",
    floats="recall fpr",
    dates="metric_date",
    scale=9,
)
def a08(t):
    return joins.pivot_metrics(t.daily_metrics, ["recall", "fpr"])


@query(
    "a09_failure_medians",
    """SELECT equipment_type, quantile_cont(tool_wear_min, 0.5) AS median_tool_wear,
              quantile_cont(torque_nm, 0.5) AS median_torque,
              avg(process_temperature_k - air_temperature_k) AS avg_temp_diff, count(*) AS failure_count
       FROM {cleaned} WHERE target = 1 AND is_valid GROUP BY equipment_type""",
    floats="median_tool_wear median_torque avg_temp_diff",
)
def a09(t):
    return profiling.failure_medians(t.cleaned)


_EFFECT = """
    count(CASE WHEN actual = 1 THEN 1 END) AS actual_failures,
    count(CASE WHEN predicted = 1 THEN 1 END) AS predicted_failures,
    count(CASE WHEN predicted = 1 AND actual = 1 THEN 1 END) AS true_positives,
    count(CASE WHEN predicted = 0 AND actual = 1 THEN 1 END) AS false_negatives,
    count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END) AS false_positives,
    round(100.0 * count(CASE WHEN predicted = 1 AND actual = 1 THEN 1 END)
          / nullif(count(CASE WHEN actual = 1 THEN 1 END), 0), 2) AS recall_percent,
    round(100.0 * count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END)
          / nullif(count(CASE WHEN predicted = 1 THEN 1 END), 0), 2) AS fdr_percent,
    round(100.0 * count(CASE WHEN predicted = 1 AND actual = 0 THEN 1 END)
          / nullif(count(CASE WHEN actual = 0 THEN 1 END), 0), 2) AS fpr_percent"""


@query(
    "a10_model_effectiveness",
    f"""SELECT equipment_type, count(*) AS total_predictions, {_EFFECT}
        FROM {{predictions}} p JOIN {{equipment}} e ON p.equipment_id = e.equipment_id
        WHERE {_RECENT} AND {_PRODUCTION} GROUP BY equipment_type""",
    floats="recall_percent fdr_percent fpr_percent",
)
def a10(t):
    known = joins.production_only(_recent(t).filter(F.col("actual").isNotNull()), t.models)
    return evaluation.model_effectiveness(joins.with_equipment(known, t.equipment, ["equipment_type"]))


_DAILY = """
    SELECT CAST(cleaned_at AS DATE) AS statistic_date, count(*) AS total_records,
           count(CASE WHEN is_valid THEN 1 END) AS valid_records, count(CASE WHEN NOT is_valid THEN 1 END) AS invalid_records,
           avg(air_temperature_k) AS avg_air_temp, avg(process_temperature_k) AS avg_process_temp,
           count(CASE WHEN target = 1 THEN 1 END) AS failure_count,
           round(100.0 * count(CASE WHEN target = 1 THEN 1 END) / count(*), 2) AS failure_rate_percent
    FROM {cleaned} GROUP BY 1"""


@query("a11_daily_statistics", _DAILY, floats="avg_air_temp avg_process_temp failure_rate_percent", dates="statistic_date", scale=9)
def a11(t):
    return reports.daily_statistics(t.cleaned)


@query(
    "a42_batch_summary",
    """SELECT batch_id, count(*) AS total_requests, count(nullif(tax, 0)) AS successful,
              count(*) - count(nullif(tax, 0)) AS failed, sum(inference_time_ms) AS total_inference_time_ms,
              sum(inference_time_ms) / greatest(count(nullif(tax, 0)), 1) AS avg_inference_time_ms
       FROM {predictions} GROUP BY batch_id""",
    floats="total_inference_time_ms avg_inference_time_ms",
    scale=5,
)
def a42(t):
    scored = t.predictions.withColumn("failure_probability", F.nullif(F.col("tax"), F.lit(0.0)))
    return reports.batch_summary(scored)


_REPORT_DAY = "2001-05-15"


@query(
    "a47_daily_report",
    f"""WITH d AS (SELECT CAST(created_at AS DATE) AS day, count(*) AS n, count(CASE WHEN is_valid THEN 1 END) AS v,
                          sum(target) AS f FROM {{cleaned}} GROUP BY 1),
             l AS (SELECT *, lag(n) OVER (ORDER BY day) AS pn, lag(f) OVER (ORDER BY day) AS pf FROM d),
             x AS (SELECT * FROM l WHERE day = DATE '{_REPORT_DAY}')
        SELECT 'Processed Records' AS metric_name, CAST(n AS VARCHAR) AS metric_value,
               CASE WHEN n > pn THEN '↑' WHEN n < pn THEN '↓' ELSE '→' END AS metric_trend FROM x
        UNION ALL SELECT 'Data Quality (%)', CAST(round(100.0 * v / n, 1) AS VARCHAR), '→' FROM x
        UNION ALL SELECT 'Failure Count', CAST(f AS VARCHAR), CASE WHEN f > pf THEN '↑' WHEN f < pf THEN '↓' ELSE '→' END FROM x
        UNION ALL SELECT 'Model Recall (%)', CAST(round(max(metric_value) * 100, 1) AS VARCHAR), '→' FROM {{daily_metrics}}
                  WHERE metric_date = DATE '{_REPORT_DAY}' AND metric_name = 'recall'""",
)
def a47(t):
    return reports.daily_report(t.cleaned, t.daily_metrics, _REPORT_DAY)


# --- joins -----------------------------------------------------------------------------------------------


@query(
    "j01_predictions_with_equipment",
    """SELECT prediction_id, equipment_type, tool_wear_min FROM {predictions} p
       JOIN {equipment} e ON p.equipment_id = e.equipment_id""",
)
def j01(t):
    joined = joins.with_equipment(t.predictions, t.equipment, ["equipment_type", "tool_wear_min"])
    return joined.select("prediction_id", "equipment_type", "tool_wear_min")


@query(
    "j02_current_predictions",
    """SELECT equipment_id, prediction_timestamp, failure_probability, predicted, model_name, model_version
       FROM {predictions} p JOIN {models} m ON p.model_id = m.model_id WHERE is_production""",
    floats="failure_probability",
    times="prediction_timestamp",
)
def j02(t):
    return joins.current_predictions(t.predictions, t.models)


@query("j03_production_semi_join", f"SELECT prediction_id FROM {{predictions}} WHERE {_PRODUCTION}")
def j03(t):
    return joins.production_only(t.predictions, t.models).select("prediction_id")


@query(
    "j04_quality_report",
    f"""SELECT statistic_date, total_records, failure_count, coalesce(m.recall, 0) AS model_recall,
               coalesce(m.precision, 0) AS model_precision
        FROM ({_DAILY}) d LEFT JOIN (SELECT metric_date, max(CASE WHEN metric_name = 'recall' THEN metric_value END) AS recall,
             max(CASE WHEN metric_name = 'precision' THEN metric_value END) AS precision
             FROM {{model_metrics}} WHERE {_PRODUCTION} GROUP BY metric_date) m ON d.statistic_date = m.metric_date
        WHERE statistic_date >= DATE '{LINES_NOW[:10]}' - INTERVAL '30' DAY""",
    floats="model_recall model_precision",
    dates="statistic_date",
    scale=9,
)
def j04(t):
    first = F.date_sub(F.lit(LINES_NOW[:10]).cast("date"), 30)
    daily = reports.daily_statistics(t.cleaned.filter(F.col("cleaned_at") >= first.cast("timestamp_ntz")))
    metrics = t.model_metrics.filter(F.col("metric_date") >= first)
    report = joins.quality_report(daily, metrics, t.models.filter("is_production"))
    return report.select("statistic_date", "total_records", "failure_count", "model_recall", "model_precision")


@query(
    "j05_global_statistics",
    """SELECT udi, id, air_temperature_k - (SELECT avg(air_temperature_k) FROM {raw_equipment}) AS air_offset,
              torque_nm / (SELECT max(torque_nm) FROM {raw_equipment}) AS torque_share FROM {raw_equipment}""",
    floats="id air_offset torque_share",
)
def j05(t):
    statistics = t.raw_equipment.agg(
        F.struct(F.avg("air_temperature_k").alias("air"), F.max("torque_nm").alias("torque"))
    ).scalar()
    return t.raw_equipment.withColumn("s", statistics).select(
        "udi",
        "id",
        (F.col("air_temperature_k") - F.col("s.air")).alias("air_offset"),
        (F.col("torque_nm") / F.col("s.torque")).alias("torque_share"),
    )


@query(
    "j07_equipment_health",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY reading_time DESC, reading_id DESC) AS rn
                  FROM {readings}),
            p AS (SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY prediction_timestamp DESC,
                                               prediction_id DESC) AS rn FROM {predictions})
       SELECT e.equipment_id, e.equipment_type, r.reading_time AS last_reading, r.value,
              p.prediction_timestamp AS last_prediction, p.failure_probability, a.alert_id, a.alert_severity
       FROM {equipment} e LEFT JOIN r ON e.equipment_id = r.equipment_id AND r.rn = 1
       LEFT JOIN p ON e.equipment_id = p.equipment_id AND p.rn = 1
       LEFT JOIN {alerts} a ON e.equipment_id = a.equipment_id AND NOT a.is_resolved""",
    floats="value failure_probability",
    times="last_reading last_prediction",
)
def j07(t):
    open_alerts = t.alerts.filter(~F.col("is_resolved")).select("equipment_id", "alert_id", "alert_severity")
    health = joins.equipment_health(
        t.equipment.select("equipment_id", "equipment_type"),
        t.readings.select("equipment_id", "reading_time", "reading_id", "value"),
        t.predictions.select("equipment_id", "prediction_timestamp", "prediction_id", "failure_probability"),
        open_alerts,
    )
    return health.select(
        "equipment_id",
        "equipment_type",
        F.col("reading_time").alias("last_reading"),
        "value",
        F.col("prediction_timestamp").alias("last_prediction"),
        "failure_probability",
        "alert_id",
        "alert_severity",
    )


@query(
    "j09_delete_using",
    """SELECT udi, id FROM {raw_equipment} r WHERE id = (SELECT min(id) FROM {raw_equipment} x WHERE x.udi = r.udi)""",
    floats="id",
)
def j09(t):
    return tables.remove_duplicates_of_first(t.raw_equipment, ["udi"], "id").select("udi", "id")


@query(
    "j13_foreign_keys",
    """SELECT 'orders.customer' AS relation, count(DISTINCT o_custkey) AS orphan_keys, count(*) AS orphan_rows
       FROM {orders} WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer})
       UNION ALL SELECT 'lineitem.part', count(DISTINCT l_partkey), count(*) FROM {lineitem}
                 WHERE l_partkey NOT IN (SELECT p_partkey FROM {part})
       UNION ALL SELECT 'lineitem.order', count(DISTINCT l_orderkey), count(*) FROM {lineitem}
                 WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders})
       UNION ALL SELECT 'events.supplier', count(DISTINCT user_id), count(*) FROM {events}
                 WHERE user_id NOT IN (SELECT s_suppkey FROM {supplier})
       UNION ALL SELECT 'customer.nation', count(DISTINCT c_nationkey), count(*) FROM {customer}
                 WHERE c_nationkey NOT IN (SELECT n_nationkey FROM {nation})
       UNION ALL SELECT 'nation.region', count(DISTINCT n_regionkey), count(*) FROM {nation}
                 WHERE n_regionkey NOT IN (SELECT r_regionkey FROM {region})""",
)
def j13(t):
    return joins.orphan_counts(
        [
            ("orders.customer", t.orders, "o_custkey", t.customer, "c_custkey"),
            ("lineitem.part", t.lineitem, "l_partkey", t.part, "p_partkey"),
            ("lineitem.order", t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            ("events.supplier", t.events, "user_id", t.supplier, "s_suppkey"),
            ("customer.nation", t.customer, "c_nationkey", t.nation, "n_nationkey"),
            ("nation.region", t.nation, "n_regionkey", t.region, "r_regionkey"),
        ]
    )


# --- rankings --------------------------------------------------------------------------------------------


@query(
    "t01_w06_top_risky_recent",
    f"""SELECT p.equipment_id, equipment_type, tool_wear_min, torque_nm, failure_probability, prediction_timestamp,
               rank() OVER (ORDER BY failure_probability DESC) AS risk_rank
        FROM {{predictions}} p JOIN {{equipment}} e ON p.equipment_id = e.equipment_id
        WHERE prediction_timestamp >= TIMESTAMP '{LINES_NOW}' - INTERVAL '1' HOUR AND predicted = 1 AND {_PRODUCTION}
        ORDER BY failure_probability DESC, p.equipment_id, prediction_id LIMIT 10""",
    floats="torque_nm failure_probability",
    times="prediction_timestamp",
)
def t01(t):
    since = _now(LINES_NOW) - F.expr("INTERVAL '1' HOUR")
    return reports.top_risky_recent(t.predictions, t.models, t.equipment, since)


_LATEST = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY prediction_timestamp DESC,
                                                prediction_id DESC) AS rn
                   FROM {{predictions}} WHERE {_PRODUCTION} AND %s) x WHERE rn = 1"""


@query(
    "t02_j08_w08_top_risky_equipment",
    f"""SELECT l.equipment_id, e.equipment_type, l.failure_probability,
               CASE WHEN p > 0.7 THEN 'CRITICAL' WHEN p > 0.5 THEN 'HIGH' WHEN p > 0.3 THEN 'MEDIUM' ELSE 'LOW' END
                   AS risk_category,
               e.tool_wear_min AS tool_wear, date_diff('day', f.first, DATE '{LINES_NOW[:10]}') AS last_maintenance_days
        FROM ({_LATEST % "predicted = 1 AND p >= 0.3"}) l JOIN {{equipment}} e ON l.equipment_id = e.equipment_id
        LEFT JOIN (SELECT product_id, min(CAST(timestamp AS DATE)) AS first FROM {{cleaned}} GROUP BY product_id) f
          ON l.equipment_id = f.product_id
        ORDER BY l.failure_probability DESC, l.equipment_id LIMIT 20""",
    floats="failure_probability",
)
def t02(t):
    first_seen = t.cleaned.select(F.col("product_id").alias("equipment_id"), F.to_date("timestamp").alias("feature_date"))
    top = reports.top_risky_equipment(
        t.predictions, t.models, t.equipment, first_seen, F.lit(LINES_NOW[:10]).cast("date"), limit=20
    )
    return top.withColumn("last_maintenance_days", F.col("last_maintenance_days").cast("long"))


@query(
    "w09_z01_equipment_risk",
    f"""SELECT equipment_id, CASE WHEN p > 0.7 THEN 'CRITICAL' WHEN p > 0.5 THEN 'HIGH' WHEN p > 0.3 THEN 'MEDIUM'
                   ELSE 'LOW' END AS risk_category, failure_probability, prediction_timestamp AS last_prediction,
               CASE WHEN predicted = 1 THEN CASE WHEN p > 0.7 THEN 100 WHEN p > 0.5 THEN 75 WHEN p > 0.3 THEN 50
                    ELSE 25 END ELSE 0 END AS risk_score
        FROM ({_LATEST % "true"}) l""",
    floats="failure_probability",
    times="last_prediction",
)
def w09(t):
    return reports.equipment_risk(t.predictions, t.models)


@query(
    "t03_open_alerts",
    f"""SELECT alert_id, alert_severity, CASE alert_severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3
                   WHEN 'low' THEN 4 END AS severity_rank,
               date_diff('second', created_at, TIMESTAMP '{ORDERS_NOW}') AS age_seconds
        FROM {{alerts}} WHERE NOT is_resolved""",
)
def t03(t):
    ranked = reports.open_alerts_by_severity(t.alerts, _now(ORDERS_NOW))
    return ranked.select("alert_id", "alert_severity", "severity_rank", "age_seconds")


@query(
    "t04_latest_imports",
    """SELECT file_name, status, records_count, started_at, completed_at,
              date_diff('second', started_at, completed_at) AS duration_seconds
       FROM {data_imports} ORDER BY started_at DESC, file_name LIMIT 10""",
    times="started_at completed_at",
)
def t04(t):
    latest = reports.latest_imports(t.data_imports)
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    return latest.withColumn("duration_seconds", seconds).drop("duration")


@query(
    "t05_active_models",
    """SELECT model_id, model_name, model_version, model_type, training_date,
              json_extract_string(performance_metrics, '$.recall') AS recall,
              json_extract_string(performance_metrics, '$.fpr') AS fpr,
              json_extract_string(performance_metrics, '$.auc_roc') AS auc_roc, is_production
       FROM {models} WHERE is_active ORDER BY training_date DESC, model_id LIMIT 5""",
    dates="training_date",
)
def t05(t):
    return reports.active_models(t.models).select(
        "model_id", "model_name", "model_version", "model_type", "training_date", "recall", "fpr", "auc_roc", "is_production"
    )


@query(
    "t07_maintenance_priority",
    f"""WITH w AS (SELECT product_id AS equipment_id, tool_wear_min FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                       ORDER BY cleaned_at DESC, tool_wear_min DESC NULLS LAST) AS rn FROM {{cleaned}}) x WHERE rn = 1)
        SELECT r.equipment_id, r.risk_score, w.tool_wear_min, coalesce(f.days, 0) AS days,
               r.risk_score * 5 + CAST(floor(least(w.tool_wear_min, 300) / 3) AS BIGINT) + coalesce(f.days, 0) * 2 AS priority
        FROM (SELECT equipment_id, CASE WHEN predicted = 1 THEN CASE WHEN p > 0.7 THEN 100 WHEN p > 0.5 THEN 75
                     WHEN p > 0.3 THEN 50 ELSE 25 END ELSE 0 END AS risk_score FROM ({_LATEST % "true"}) l) r
        JOIN w ON r.equipment_id = w.equipment_id
        LEFT JOIN (SELECT product_id, date_diff('day', min(CAST(timestamp AS DATE)), DATE '{LINES_NOW[:10]}') AS days
                   FROM {{cleaned}} GROUP BY product_id) f ON r.equipment_id = f.product_id""",
)
def t07(t):
    risk = reports.equipment_risk(t.predictions, t.models)
    seen = t.cleaned.select(F.col("product_id").alias("equipment_id"), "timestamp")
    ages = entity_age(seen, "equipment_id", "timestamp", _now(LINES_NOW)).select(
        "equipment_id", F.col("age_days").cast("long").alias("age_days")
    )
    return reports.maintenance_priority(risk, reports.latest_wear(t.cleaned, "product_id").withColumnRenamed("product_id", "equipment_id"), ages)


@query(
    "w09_latest_wear",
    """SELECT product_id, tool_wear_min FROM (SELECT *, row_number() OVER (PARTITION BY product_id
           ORDER BY cleaned_at DESC, tool_wear_min DESC NULLS LAST) AS rn FROM {cleaned}) x WHERE rn = 1""",
)
def w09b(t):
    return reports.latest_wear(t.cleaned, "product_id")


# --- sets and tables -------------------------------------------------------------------------------------


@query(
    "u01_union_all",
    """SELECT 'orders' AS table_name, count(*) AS n FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem}
       UNION ALL SELECT 'events', count(*) FROM {events}""",
)
def u01(t):
    sizes = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        for name, df in (("orders", t.orders), ("lineitem", t.lineitem), ("events", t.events))
    ]
    return profiling.union_all(*sizes)


@query(
    "u03_first_per_key",
    """SELECT udi, id, product_id FROM (SELECT *, row_number() OVER (PARTITION BY udi ORDER BY id) AS rn
       FROM {raw_equipment}) x WHERE rn = 1""",
    floats="id",
)
def u03(t):
    return tables.first_per_key(t.raw_equipment, ["udi"], ["id"]).select("udi", "id", "product_id")


@query(
    "u06_retention",
    f"""SELECT 'raw' AS layer, count(CASE WHEN timestamp < DATE '{LINES_NOW[:10]}' - INTERVAL '365' DAY THEN 1 END) AS deleted,
               count(CASE WHEN timestamp >= DATE '{LINES_NOW[:10]}' - INTERVAL '365' DAY THEN 1 END) AS kept FROM {{raw_equipment}}
        UNION ALL
        SELECT 'cleaned', count(CASE WHEN cleaned_at < DATE '{LINES_NOW[:10]}' - INTERVAL '730' DAY THEN 1 END),
               count(CASE WHEN cleaned_at >= DATE '{LINES_NOW[:10]}' - INTERVAL '730' DAY THEN 1 END) FROM {{cleaned}}""",
)
def u06(t):
    now = _now(LINES_NOW)
    return tables.retention_counts(
        [("raw", t.raw_equipment, "timestamp", 365), ("cleaned", t.cleaned, "cleaned_at", 730)], now
    )


@query(
    "s09_head_sample",
    """SELECT udi, id, product_id FROM {raw_equipment} ORDER BY timestamp, udi, id LIMIT 100""",
    floats="id",
)
def s09(t):
    return reports.head_sample(t.raw_equipment, ["timestamp", "udi", "id"]).select("udi", "id", "product_id")


@query(
    "m21_alert_states",
    f"""SELECT alert_id, is_resolved AS resolved, CASE WHEN is_resolved THEN 'resolved' WHEN alert_severity = 'critical'
               THEN 'acknowledged' ELSE 'open' END AS state FROM {{alerts}}""",
)
def m21(t):
    opened = t.alerts.select("alert_id", F.lit("open").alias("event"), F.col("created_at").alias("event_time"))
    later = F.col("created_at") + F.expr("INTERVAL '1' HOUR")
    seen = t.alerts.filter("alert_severity = 'critical'").select(
        "alert_id", F.lit("acknowledged").alias("event"), later.alias("event_time")
    )
    closed = t.alerts.filter("is_resolved").select(
        "alert_id", F.lit("resolved").alias("event"), later.alias("event_time")
    )
    states = tables.alert_states(opened.unionByName(seen).unionByName(closed))
    return states.select("alert_id", "resolved", "state")


@query(
    "m19_promote_models",
    """WITH incoming AS (SELECT model_type, concat(model_type, '_next') AS model_id FROM {models} GROUP BY model_type
                         HAVING NOT bool_and(is_production)),
            merged AS (SELECT model_id, model_type, is_production FROM {models}
                       UNION ALL SELECT model_id, model_type, true FROM incoming)
       SELECT m.model_id, m.model_type, CASE WHEN i.model_id IS NOT NULL AND m.model_id <> i.model_id THEN false
              ELSE m.is_production END AS is_production
       FROM merged m LEFT JOIN incoming i ON m.model_type = i.model_type""",
)
def m19(t):
    now = _now(LINES_NOW)
    current = t.models.select("model_id", "model_type", "is_production", "training_date").withColumns(
        {"created_at": now, "updated_at": now}
    )
    incoming = (
        t.models.groupBy("model_type")
        .agg(F.bool_and("is_production").alias("all_live"))
        .filter("NOT all_live")
        .select(
            F.concat("model_type", F.lit("_next")).alias("model_id"),
            "model_type",
            F.lit(True).alias("is_production"),
            F.to_date(now).alias("training_date"),
            now.alias("created_at"),
        )
    )
    merged = tables.promote_model(current, incoming, now)
    return merged.select("model_id", "model_type", "is_production")


