"""Queries of the feature-store operators and of the windowed sensor statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import joins, store
from assetlake.plans.queries_rules import READING_REGISTRY
from assetlake.plans.registry import query
from assetlake.plans.views import EVENTS_NOW
from assetlake.streaming import windows

NAMES = ["click", "view", "purchase"]


def _now():
    return F.lit(EVENTS_NOW).cast("timestamp_ntz")


def _wide_readings(t):
    """One wide row per reading: the reading's value under the column of its sensor."""
    return t.readings.select(
        "equipment_id",
        F.col("reading_time").alias("timestamp"),
        *[F.when(F.col("sensor") == n, F.col("value")).alias(n) for n in NAMES],
    )


_LONG = " UNION ALL ".join(
    f"SELECT equipment_id, '{n}' AS feature_name, CASE WHEN sensor = '{n}' THEN value END AS feature_value, "
    "reading_time AS timestamp FROM {readings}"
    for n in NAMES
)


@query("m01_wide_to_long", _LONG, floats="feature_value", times="timestamp")
def m01(t):
    return store.to_long(_wide_readings(t), NAMES)


@query(
    "m02_upsert_last_write",
    """SELECT equipment_id, feature_name, timestamp, feature_value FROM (
         SELECT *, row_number() OVER (PARTITION BY equipment_id, feature_name, timestamp ORDER BY created_at DESC, side DESC) AS rn
         FROM (SELECT equipment_id, feature_name, timestamp, feature_value, created_at, 0 AS side FROM {offline}
               UNION ALL SELECT equipment_id, feature_name, timestamp, max(feature_value) * 2,
                                max(created_at), 1 FROM {feature_writes}
                         WHERE timestamp >= TIMESTAMP '2024-01-20 00:00:00'
                         GROUP BY equipment_id, feature_name, timestamp) u) x WHERE rn = 1""",
    floats="feature_value",
    times="timestamp",
)
def m02(t):
    late = t.feature_writes.filter(F.col("timestamp") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    incoming = late.groupBy("equipment_id", "feature_name", "timestamp").agg(
        (F.max("feature_value") * 2).alias("feature_value"), F.max("created_at").alias("created_at")
    )
    merged = store.upsert_features(t.offline, incoming)
    return merged.select("equipment_id", "feature_name", "timestamp", "feature_value")




@query(
    "m03_validated_ingest",
    """SELECT equipment_id, feature_name, feature_value, timestamp FROM (
         SELECT equipment_id, 'click' AS feature_name, value AS feature_value, reading_time AS timestamp FROM {readings}
           WHERE sensor = 'click' AND value BETWEEN 1 AND 100
         UNION ALL SELECT equipment_id, 'view', value, reading_time FROM {readings} WHERE sensor = 'view' AND value >= 0.5
         UNION ALL SELECT equipment_id, 'purchase', value, reading_time FROM {readings} WHERE sensor = 'purchase' AND value <= 200) x""",
    floats="feature_value",
    times="timestamp",
)
def m03(t):
    registry = store.registry_frame(t.spark, READING_REGISTRY)
    return store.ingest(_wide_readings(t), NAMES, registry)[0]


@query(
    "m03_rejected_values",
    """SELECT error, count(*) AS n FROM (
         SELECT CASE WHEN sensor <> 'click' THEN 'Expected numeric' WHEN value < 1 THEN 'Value below minimum'
                     WHEN value > 100 THEN 'Value above maximum' END AS error FROM {readings}
         UNION ALL SELECT CASE WHEN sensor <> 'view' THEN 'Expected numeric' WHEN value < 0.5 THEN 'Value below minimum' END FROM {readings}
         UNION ALL SELECT CASE WHEN sensor <> 'purchase' THEN 'Expected numeric' WHEN value > 200 THEN 'Value above maximum' END
                   FROM {readings}) e WHERE error IS NOT NULL GROUP BY error""",
)
def m03b(t):
    registry = store.registry_frame(t.spark, READING_REGISTRY)
    rejected = store.ingest(_wide_readings(t), NAMES, registry)[2]
    return rejected.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m04_record_ingest",
    """SELECT count(CASE WHEN event_type <> 'error' THEN 1 END) AS accepted, count(CASE WHEN event_type = 'error' THEN 1 END) AS refused
       FROM {events}""",
)
def m04(t):
    records = t.events.select(
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("equipment_id"),
        F.col("ts").alias("timestamp"),
        "value",
    )
    _, refused, accepted = store.ingest_records(records, ["value"])
    bad = refused.agg(F.count(F.lit(1))).scalar()
    return accepted.select(F.col("success_count").alias("accepted")).withColumn("refused", bad)


def _online_rows(t):
    """Feature maps of every (entity, hour) of the offline history, as arriving at their write time."""
    return t.offline.groupBy("equipment_id", "timestamp").agg(
        F.map_from_entries(F.collect_set(F.struct("feature_name", "feature_value"))).alias("features"),
        F.max("created_at").alias("ingestion_time"),
    )


_ONLINE = """
    o AS (SELECT f.equipment_id, f.feature_name, f.feature_value, f.timestamp, n.ingestion_time, n.feature_count
          FROM {offline} f JOIN (SELECT equipment_id, timestamp, max(created_at) AS ingestion_time, count(*) AS feature_count,
                                        row_number() OVER (PARTITION BY equipment_id ORDER BY timestamp DESC) AS rn
                                 FROM {offline} GROUP BY equipment_id, timestamp) n
            ON f.equipment_id = n.equipment_id AND f.timestamp = n.timestamp AND n.rn = 1)"""


def _flat(online, *extra):
    return online.select("equipment_id", F.explode("features").alias("feature_name", "feature_value"), *extra)


@query(
    "m05_online_state",
    f"WITH {_ONLINE} SELECT equipment_id, feature_name, feature_value, timestamp, ingestion_time, feature_count FROM o",
    floats="feature_value",
    times="timestamp ingestion_time",
)
def m05(t):
    return _flat(store.online_state(_online_rows(t)), "timestamp", "ingestion_time", F.col("feature_count").cast("long").alias("feature_count"))


@query(
    "m06_online_ttl",
    f"WITH {_ONLINE} SELECT DISTINCT equipment_id FROM o WHERE ingestion_time > TIMESTAMP '{EVENTS_NOW}' - INTERVAL '1' DAY",
)
def m06(t):
    return store.unexpired(store.online_state(_online_rows(t)), _now(), days=1).select("equipment_id")


@query(
    "m07_selected_features",
    f"WITH {_ONLINE} SELECT equipment_id, feature_name, feature_value FROM o WHERE feature_name IN ('click', 'view')",
    floats="feature_value",
)
def m07(t):
    return _flat(store.select_features(store.online_state(_online_rows(t)), ["click", "view"]))


@query(
    "m08_feature_vector",
    f"""WITH {_ONLINE} SELECT equipment_id, coalesce(max(CASE WHEN feature_name = 'click' THEN feature_value END), 0) AS v0,
               coalesce(max(CASE WHEN feature_name = 'view' THEN feature_value END), 0) AS v1, 0.0 AS v2
        FROM o GROUP BY equipment_id""",
    floats="v0 v1 v2",
)
def m08(t):
    online = store.online_state(_online_rows(t))
    vector = online.select("equipment_id", store.feature_vector("features", ["click", "view", "absent"]).alias("v"))
    return vector.select("equipment_id", *[F.col("v")[i].alias(f"v{i}") for i in range(3)])


@query(
    "m09_freshness",
    f"""WITH {_ONLINE} SELECT DISTINCT equipment_id, ingestion_time > TIMESTAMP '{EVENTS_NOW}' - INTERVAL '600' MINUTE AS fresh
        FROM o""",
)
def m09(t):
    return store.online_state(_online_rows(t)).select("equipment_id", store.is_fresh(_now(), 600).alias("fresh"))


@query(
    "m10_delete_entities",
    f"WITH {_ONLINE} SELECT DISTINCT equipment_id FROM o WHERE equipment_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM {{supplier}})",
)
def m10(t):
    doomed = t.supplier.select(F.col("s_suppkey").cast("string").alias("equipment_id"))
    return store.forget(store.online_state(_online_rows(t)), doomed).select("equipment_id")


_RECENT = f"""SELECT *, max(timestamp) OVER (PARTITION BY equipment_id) AS newest FROM {{offline}}
    WHERE timestamp >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL '1' DAY AND timestamp <= TIMESTAMP '{EVENTS_NOW}'"""


@query(
    "m11_sync_to_online",
    f"SELECT equipment_id, feature_name, feature_value, timestamp FROM ({_RECENT}) r WHERE timestamp = newest",
    floats="feature_value",
    times="timestamp",
)
def m11(t):
    return _flat(store.sync_to_online(t.offline, _now()), "timestamp")


@query(
    "m12_long_to_wide",
    """SELECT equipment_id, timestamp, avg(CASE WHEN feature_name = 'click' THEN feature_value END) AS click,
              avg(CASE WHEN feature_name = 'view' THEN feature_value END) AS view,
              avg(CASE WHEN feature_name = 'purchase' THEN feature_value END) AS purchase
       FROM {feature_writes} GROUP BY equipment_id, timestamp""",
    floats="click view purchase",
    times="timestamp",
    scale=5,
)
def m12(t):
    return store.to_wide(t.feature_writes, NAMES)


@query(
    "m13_u05_training_frame",
    """SELECT equipment_id, timestamp, avg(CASE WHEN feature_name = 'click' THEN feature_value END) AS click,
              avg(CASE WHEN feature_name = 'view' THEN feature_value END) AS view
       FROM {offline} WHERE feature_name IN ('click', 'view')
         AND timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'
       GROUP BY equipment_id, timestamp""",
    floats="click view",
    times="timestamp",
)
def m13(t):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-25 00:00:00"))
    return store.training_frame(t.offline, ["click", "view"], start, end)


@query(
    "u04_active_entities",
    """SELECT DISTINCT equipment_id FROM {offline}
       WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 00:00:00'""",
)
def u04(t):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-11 00:00:00"))
    return store.active_entities(t.offline, start, end)


@query(
    "a12_feature_statistics",
    """SELECT feature_name, count(*) AS count, min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp,
              count(DISTINCT equipment_id) AS unique_equipment FROM {offline} GROUP BY feature_name""",
    times="min_timestamp max_timestamp",
)
def a12(t):
    return store.feature_statistics(t.offline)


@query(
    "a13_entity_statistics",
    f"""SELECT equipment_id, feature_name, avg(feature_value) AS mean, stddev_samp(feature_value) AS std,
               min(feature_value) AS min, max(feature_value) AS max, count(feature_value) AS count
        FROM {{offline}} WHERE timestamp BETWEEN TIMESTAMP '{EVENTS_NOW}' - INTERVAL '10' DAY AND TIMESTAMP '{EVENTS_NOW}'
        GROUP BY equipment_id, feature_name""",
    floats="mean std min max",
    scale=9,
)
def a13(t):
    return store.entity_statistics(t.offline, _now(), 10)


@query(
    "a14_store_summary",
    f"""WITH {_ONLINE} SELECT count(*) AS offline_rows, count(DISTINCT feature_name) AS features,
               count(DISTINCT equipment_id) AS entities, max(timestamp) AS newest_offline,
               (SELECT count(DISTINCT equipment_id) FROM o) AS online_keys, (SELECT max(timestamp) FROM o) AS newest_online
        FROM {{offline}}""",
    times="newest_offline newest_online",
)
def a14(t):
    return store.store_summary(t.offline, store.online_state(_online_rows(t)))


_SERVE = f"""
    {_ONLINE},
    w AS (SELECT equipment_id, max(ingestion_time) AS it, max(timestamp) AS ts FROM o GROUP BY equipment_id),
    r AS (SELECT * FROM (SELECT *, max(timestamp) OVER (PARTITION BY equipment_id) AS newest FROM {{offline}}
          WHERE feature_name IN ('click', 'view') AND timestamp >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL '24' HOUR
            AND timestamp <= TIMESTAMP '{EVENTS_NOW}') x WHERE timestamp = newest),
    q AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS equipment_id FROM {{customer}})"""


def _serve_sql(fresh):
    return f"""WITH {_SERVE},
        j AS (SELECT q.equipment_id, coalesce({fresh}, false) AS fresh, w.ts, n.newest FROM q
              LEFT JOIN w ON q.equipment_id = w.equipment_id
              LEFT JOIN (SELECT equipment_id, max(newest) AS newest FROM r GROUP BY equipment_id) n
                ON q.equipment_id = n.equipment_id)
        SELECT j.equipment_id, j.fresh, CASE WHEN j.fresh THEN 'online_store' WHEN j.newest IS NOT NULL THEN 'offline_store'
               ELSE 'none' END AS source, CASE WHEN j.fresh THEN j.ts ELSE j.newest END AS timestamp,
               coalesce(max(CASE WHEN j.fresh THEN o.feature_value ELSE r.feature_value END), -1) AS best_value
        FROM j LEFT JOIN o ON j.equipment_id = o.equipment_id AND o.feature_name IN ('click', 'view')
        LEFT JOIN r ON j.equipment_id = r.equipment_id
        GROUP BY ALL"""


def _served(t, max_age):
    requested = t.customer.select(F.col("c_custkey").cast("string").alias("equipment_id"))
    served = joins.serve_features(
        requested, store.online_state(_online_rows(t)), t.offline, ["click", "view"], _now(), max_age
    )
    best = F.coalesce(F.array_max(F.map_values("features")), F.lit(-1.0))
    return served.select("equipment_id", "fresh", "source", "timestamp", best.alias("best_value"))


@query(
    "j11_serve_with_fallback",
    _serve_sql(f"date_diff('second', w.it, TIMESTAMP '{EVENTS_NOW}') < 18000"),
    floats="best_value",
    times="timestamp",
)
def j11(t):
    return _served(t, 300)


@query("j12_batch_serve", _serve_sql("w.equipment_id IS NOT NULL"), floats="best_value", times="timestamp")
def j12(t):
    return _served(t, None)


# --- windowed sensor statistics --------------------------------------------------------------------------

# one row per (reading, sliding day that contains it); days start every six hours
_SLIDING = """
    s AS (SELECT sensor AS equipment_id, 'value' AS sensor, value,
                 time_bucket(INTERVAL '6 hours', reading_time, TIMESTAMP '2024-01-01 00:00:00')
                     - k * INTERVAL '6' HOUR AS window_start
          FROM {readings}, range(0, 4) g(k)),
    a AS (SELECT equipment_id, sensor, window_start, window_start + INTERVAL '1' DAY AS window_end, count(*) AS count,
                 avg(value) AS mean, quantile_cont(value, 0.5) AS median, coalesce(stddev_samp(value), 0) AS std,
                 min(value) AS min, max(value) AS max, max(value) - min(value) AS range
          FROM s GROUP BY 1, 2, 3, 4)"""
_LEVEL = "CASE WHEN max >= 400 THEN 'critical' WHEN max >= 300 THEN 'warning' ELSE 'normal' END"
LIMITS = {"value": (300.0, 400.0)}


def _series(t):
    """The readings as one series per event type, so that a day holds many of them."""
    return t.readings.select(
        F.col("sensor").alias("equipment_id"), F.lit("value").alias("sensor"), "value", F.col("reading_time").alias("event_time")
    )


@query(
    "x05_sliding_statistics",
    f"WITH {_SLIDING} SELECT * FROM a",
    floats="mean median std min max range",
    times="window_start window_end",
    scale=9,
)
def x05(t):
    return windows.batch_statistics(_series(t), "1 day", "6 hours")


@query(
    "x06_window_anomalies",
    f"""WITH {_SLIDING} SELECT s.equipment_id, s.sensor, s.window_start, count(*) AS anomaly_count, max(s.value) AS largest
        FROM s JOIN a ON s.equipment_id = a.equipment_id AND s.window_start = a.window_start
        WHERE a.std > 0 AND (s.value > a.mean + 3 * a.std OR s.value < a.mean - 3 * a.std)
        GROUP BY 1, 2, 3""",
    floats="largest",
    times="window_start",
)
def x06(t):
    found = windows.batch_anomalies(_series(t), "1 day", "6 hours")
    return found.groupBy("equipment_id", "sensor", "window_start").agg(
        F.count(F.lit(1)).alias("anomaly_count"), F.max("value").alias("largest")
    )


@query(
    "x08_threshold_alerts",
    f"""WITH {_SLIDING} SELECT equipment_id, sensor, window_start, max AS value, {_LEVEL} AS level
        FROM a WHERE max >= 300""",
    floats="value",
    times="window_start",
)
def x08(t):
    alerts = windows.threshold_alerts(windows.batch_statistics(_series(t), "1 day", "6 hours"), LIMITS)
    return alerts.select("equipment_id", "sensor", "window_start", "value", "level")


@query(
    "x09_aggregate_envelope",
    f"""WITH {_SLIDING} SELECT equipment_id, window_end, 86400 AS aggregation_period, count AS value_count, {_LEVEL} AS level FROM a""",
    times="window_end",
)
def x09(t):
    levelled = windows.with_alert_level(windows.batch_statistics(_series(t), "1 day", "6 hours"), LIMITS)
    envelope = windows.envelope(levelled, 86400)
    return envelope.select(
        "equipment_id",
        F.col("timestamp").alias("window_end"),
        "aggregation_period",
        F.col("results")["value"]["count"].alias("value_count"),
        F.col("results")["value"]["alert_level"].alias("level"),
    )


