"""Domain views over the driver tables.

Every view is one SQL text that both Spark and the oracle run; ``{name}`` stands for a driver table or an
earlier view. Rows are only mapped, never sampled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# evaluation times that stand in for the clock
EVENTS_NOW = "2024-01-30 12:00:00"
LINES_NOW = "2001-06-01 12:00:00"
ORDERS_NOW = "2001-08-02 00:00:00"

VIEWS = {
    "readings": """
        SELECT CAST(user_id AS STRING) AS equipment_id, event_type AS sensor, value, ts AS reading_time,
               event_id AS reading_id, props AS payload
        FROM {events}""",
    "equipment": """
        SELECT CAST(p_partkey AS STRING) AS equipment_id, p_type AS equipment_type, p_brand AS location,
               p_size * 6 AS tool_wear_min, p_retailprice / 10 AS torque_nm
        FROM {part}""",
    "raw_equipment": """
        SELECT l_extendedprice AS id,
               concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS udi,
               CAST(l_partkey AS STRING) AS product_id,
               CASE WHEN l_linenumber <= 3 THEN 'L' WHEN l_linenumber <= 6 THEN 'M' ELSE 'H' END AS equipment_type,
               285.0 + l_quantity / 2 AS air_temperature_k,
               298.0 + l_discount * 230 AS process_temperature_k,
               CAST(floor(l_extendedprice / 30) AS INT) AS rotational_speed_rpm,
               nullif(l_quantity, 7) * 2.2 AS torque_nm,
               CAST(floor(l_tax * 4000) AS INT) AS tool_wear_min,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target,
               CASE WHEN l_returnflag = 'R' THEN 'Power Failure' ELSE 'No Failure' END AS failure_type,
               l_shipdate AS timestamp, l_linestatus AS batch_id
        FROM {lineitem}""",
    "cleaned": """
        SELECT md5(concat(udi, product_id)) AS equipment_id, udi, product_id, equipment_type,
               CASE WHEN air_temperature_k BETWEEN 290 AND 310 THEN air_temperature_k END AS air_temperature_k,
               CASE WHEN process_temperature_k BETWEEN 305 AND 320 THEN process_temperature_k END
                   AS process_temperature_k,
               CASE WHEN rotational_speed_rpm BETWEEN 1000 AND 3000 THEN rotational_speed_rpm END
                   AS rotational_speed_rpm,
               CASE WHEN torque_nm BETWEEN 0 AND 100 THEN torque_nm END AS torque_nm,
               CASE WHEN tool_wear_min BETWEEN 0 AND 300 THEN tool_wear_min END AS tool_wear_min,
               target, failure_type, timestamp, timestamp AS cleaned_at, timestamp AS created_at, id,
               torque_nm IS NOT NULL AS is_valid
        FROM {raw_equipment}""",
    "scores": """
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
                      CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)) AS prediction_id,
               CAST(l_partkey AS STRING) AS equipment_id, CAST(l_suppkey AS STRING) AS model_id,
               l_shipdate + l_linenumber * INTERVAL '1' HOUR AS prediction_timestamp,
               0.6 * l_extendedprice / 105000 + CASE WHEN l_returnflag = 'R' THEN 0.35 ELSE 0.05 END AS p,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS actual,
               40.0 + l_tax * 300 AS inference_time_ms, CAST(l_orderkey AS STRING) AS batch_id,
               l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice / 1050 AS price
        FROM {lineitem}""",
    "predictions": """
        SELECT prediction_id, equipment_id, model_id, prediction_timestamp, p, p AS failure_probability,
               CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted, actual, inference_time_ms, batch_id,
               quantity, discount, tax, price
        FROM {scores}""",
    "training_rows": """
        SELECT prediction_id, equipment_id, quantity, discount * 100 AS discount, tax * 100 AS tax, price,
               CASE WHEN 0.007 * price + 0.006 * quantity + 0.3 * actual > 0.8 THEN 1 ELSE 0 END AS label
        FROM {predictions}""",
    "models": """
        SELECT CAST(s_suppkey AS STRING) AS model_id, s_name AS model_name,
               concat('v', CAST(s_nationkey AS STRING)) AS model_version,
               concat('type_', CAST(s_nationkey AS STRING)) AS model_type,
               CAST(date_trunc('month', TIMESTAMP '2001-05-31 00:00:00') + s_nationkey * INTERVAL '1' DAY AS DATE)
                   AS training_date,
               concat('{{"recall": "0.', CAST(50 + s_nationkey AS STRING), '", "fpr": "0.0',
                      CAST(s_nationkey AS STRING), '", "auc_roc": "0.9"}}') AS performance_metrics,
               s_acctbal >= 0 AS is_production, s_acctbal >= -500 AS is_active
        FROM {supplier}""",
    "ab_tests": """
        SELECT model_type AS test_id, min(model_id) AS control_model_id, max(model_id) AS treatment_model_id,
               DATE '1998-01-01' AS start_date, DATE '2001-06-01' AS end_date
        FROM {models} GROUP BY model_type""",
    "alerts": """
        SELECT o_orderkey AS alert_id, CAST(o_custkey AS STRING) AS equipment_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
                    WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' ELSE 'none' END AS alert_severity,
               o_orderstatus = 'F' AS is_resolved, o_orderdate AS created_at, o_totalprice AS alert_value
        FROM {orders}""",
    "model_outcomes": """
        SELECT CAST(prediction_timestamp AS DATE) AS metric_date, model_id, sum(actual * predicted) AS tp,
               sum((1 - actual) * predicted) AS fp, sum(actual) AS pos, sum(1 - actual) AS neg,
               sum(predicted) AS claimed
        FROM {predictions} GROUP BY CAST(prediction_timestamp AS DATE), model_id""",
    "model_metrics": """
        SELECT metric_date, model_id, 'recall' AS metric_name, CAST(tp AS DOUBLE) / pos AS metric_value
        FROM {model_outcomes} WHERE pos > 0
        UNION ALL
        SELECT metric_date, model_id, 'fpr', CAST(fp AS DOUBLE) / neg FROM {model_outcomes} WHERE neg > 0
        UNION ALL
        SELECT metric_date, model_id, 'precision', CAST(tp AS DOUBLE) / claimed FROM {model_outcomes} WHERE claimed > 0""",
    "daily_outcomes": """
        SELECT CAST(prediction_timestamp AS DATE) AS metric_date, sum(actual * predicted) AS tp,
               sum((1 - actual) * predicted) AS fp, sum(actual) AS pos, sum(1 - actual) AS neg,
               sum(predicted) AS claimed
        FROM {predictions} GROUP BY CAST(prediction_timestamp AS DATE)""",
    "daily_metrics": """
        SELECT metric_date, 'recall' AS metric_name, CAST(tp AS DOUBLE) / pos AS metric_value
        FROM {daily_outcomes} WHERE pos > 0
        UNION ALL
        SELECT metric_date, 'fpr', CAST(fp AS DOUBLE) / neg FROM {daily_outcomes} WHERE neg > 0
        UNION ALL
        SELECT metric_date, 'precision', CAST(tp AS DOUBLE) / claimed FROM {daily_outcomes} WHERE claimed > 0""",
    "data_drift": """
        SELECT CAST(reading_time AS DATE) AS check_date, sensor AS feature_name, max(value) / 100 AS drift_score,
               CAST(2.0 AS DOUBLE) AS drift_threshold
        FROM {readings} GROUP BY CAST(reading_time AS DATE), sensor""",
    "data_imports": """
        SELECT concat('order_', CAST(o.o_orderkey AS STRING)) AS file_name,
               CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'failed' END AS status,
               count(l.l_orderkey) AS records_count, o.o_orderdate AS started_at, max(l.l_shipdate) AS completed_at
        FROM {orders} o LEFT JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey
        GROUP BY o.o_orderkey, o.o_orderstatus, o.o_orderdate""",
    "sensor_messages": """
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-',
                      CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING)) AS message_id,
               CAST(l_partkey AS STRING) AS equipment_id, l_shipdate AS timestamp,
               nullif(l_quantity, 13) * 3.2 AS temperature, l_discount * 1050 AS vibration,
               l_extendedprice / 500 AS pressure, l_extendedprice / 20 AS rotation_speed,
               l_tax * 1000 AS power_consumption
        FROM {lineitem}""",
    "requests": """
        SELECT concat(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'EQ-' WHEN 'BUILDING' THEN 'PUMP-'
                           WHEN 'FURNITURE' THEN 'COMP-' WHEN 'MACHINERY' THEN 'TURB-' ELSE 'X' END,
                      CAST(c_custkey AS STRING)) AS equipment_id,
               CASE WHEN c_nationkey < 5 THEN 'pump' WHEN c_nationkey < 10 THEN 'compressor'
                    WHEN c_nationkey < 15 THEN 'turbine' WHEN c_nationkey < 20 THEN 'conveyor' ELSE 'lathe' END
                   AS equipment_type,
               TIMESTAMP '2024-01-25 00:00:00' + CAST(floor(c_acctbal / 1000) AS INT) * INTERVAL '1' DAY AS timestamp,
               CAST(c_nationkey AS STRING) AS batch_id, c_custkey AS request_no, c_acctbal AS reading
        FROM {customer}""",
    "feature_writes": """
        SELECT equipment_id, sensor AS feature_name, value AS feature_value,
               date_trunc('hour', reading_time) AS timestamp, reading_time AS created_at, reading_id
        FROM {readings}""",
    "offline": """
        SELECT equipment_id, feature_name, max_by(feature_value, reading_id) AS feature_value, timestamp,
               max(created_at) AS created_at
        FROM {feature_writes} GROUP BY equipment_id, feature_name, timestamp""",
}

_NAME = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def referenced(sql: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(sql)))


class Tables:
    """Lazily built frames: ``tables.lineitem`` is a driver table, ``tables.readings`` a view."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in TABLES and name not in VIEWS):
            raise AttributeError(name)
        if name not in self._frames:
            if name in TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEWS[name]
                frame = self.spark.sql(text, **{n: getattr(self, n) for n in referenced(text)})
            self._frames[name] = frame
        return self._frames[name]


def oracle_text(sql: str) -> str:
    """The oracle query with the views it needs as leading CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in referenced(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)

    def plain(text: str) -> str:
        return _NAME.sub(r"\1", text).replace("{{", "{").replace("}}", "}").strip()

    body = plain(sql)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({plain(VIEWS[name])})" for name in needed)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
