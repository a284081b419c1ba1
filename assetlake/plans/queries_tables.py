"""Sources, sinks, layer tables and registries: driver tables written to the shared folder and read back."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from assetlake import schemas
from assetlake.learning import models
from assetlake.learning.splits import stratified_split
from assetlake.operators import profiling, reports, store, tables
from assetlake.plans.queries_learning import FEATURES, KEYS, labelled
from assetlake.plans.queries_streaming import _collect, _stream
from assetlake.plans.registry import query
from assetlake.plans.views import LINES_NOW, VIEWS
from assetlake.session import checkpoint_dir, cut_lineage
from assetlake.sources import catalog, files
from assetlake.streaming import messages


def _folder(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _now():
    return F.lit(LINES_NOW).cast("timestamp_ntz")


# --- files -----------------------------------------------------------------------------------------------


def _raw_file(t) -> str:
    """The equipment records as CSV under the headers of the source file."""
    path = _folder(t, "raw-csv")
    typed = [F.col(c).cast(schemas.RAW_EQUIPMENT[c].dataType).alias(header) for header, c in schemas.RAW_HEADER.items()]
    t.raw_equipment.select(*typed).write.csv(path, header=True)
    return path


@query(
    "s01_csv_scan",
    """SELECT udi, product_id, equipment_type, CAST(air_temperature_k AS DECIMAL(8, 2)) AS air_temperature_k,
              rotational_speed_rpm, CAST(torque_nm AS DECIMAL(8, 2)) AS torque_nm, tool_wear_min, target, failure_type
       FROM {raw_equipment}""",
    floats="air_temperature_k torque_nm",
)
def s01(t):
    rows = files.read_raw_csv(t.spark, _raw_file(t))
    return rows.drop("process_temperature_k")


@query(
    "s04_batch_load",
    """SELECT 'batch-1' AS run_id, 'completed' AS status, count(*) AS records_count, count(*) AS table_rows,
              true AS has_size, true AS in_order FROM {raw_equipment}""",
)
def s04(t):
    source, table, audit = _raw_file(t), _folder(t, "raw-table"), _folder(t, "audit")
    for _ in range(2):  # a repeated load replaces its batch
        files.load_batch(t.spark, source, table, audit, "batch-1")
    stored = t.spark.read.parquet(table).agg(F.count(F.lit(1)).alias("n"))
    status = files.import_status(t.spark, audit).withColumn("table_rows", stored.scalar())
    return status.select(
        "run_id",
        "status",
        "records_count",
        "table_rows",
        (F.col("file_size") > 0).alias("has_size"),
        (F.col("started_at") <= F.col("completed_at")).alias("in_order"),
    )


@query(
    "s08_prepared_export",
    """WITH n AS (SELECT label, count(*) AS total, CAST(floor(0.8::DOUBLE * (count(*) - 1)) + 1 AS BIGINT) AS train
                  FROM {training_rows} GROUP BY label)
       SELECT f.format, 'train' AS part, label, train AS n FROM n, (VALUES ('parquet'), ('csv')) f(format)
       UNION ALL
       SELECT f.format, 'test', label, total - train FROM n, (VALUES ('parquet'), ('csv')) f(format)""",
)
def s08(t):
    base = _folder(t, "prepared")
    train, test = stratified_split(labelled(t), KEYS, "label")
    files.write_prepared(train, test, base)
    schema = labelled(t).schema
    counts = None
    for part in ("train", "test"):
        stored = {
            "parquet": t.spark.read.schema(schema).parquet(f"{base}/{part}"),
            "csv": t.spark.read.schema(schema).csv(f"{base}/{part}_csv", header=True),
        }
        for kind, rows in stored.items():
            sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            sizes = sizes.select(F.lit(kind).alias("format"), F.lit(part).alias("part"), "label", "n")
            counts = sizes if counts is None else counts.unionByName(sizes)
    return counts


_REPORTED = ("air_temperature_k", "rotational_speed_rpm", "torque_nm")


@query(
    "s10_json_report",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, min({c}) AS min, max({c}) AS max FROM {{raw_equipment}}"
        for c in _REPORTED
    ),
    floats="min max",
)
def s10(t):
    path = _folder(t, "report")
    files.write_report(files.quality_report(t.raw_equipment, _REPORTED), path)
    report = t.spark.read.json(path)
    missing = report.select(F.inline("missing"))
    return missing.join(report.select(F.inline("value_ranges")), "column_name")


@query("s11_model_round_trip", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM {training_rows}")
def s11(t):
    path = _folder(t, "model")
    rows = cut_lineage(labelled(t))
    model = models.fit(stratified_split(rows, KEYS, "label")[0], models.logistic_regression(FEATURES))
    models.save(model, path)
    scored = models.score(models.load(path), models.score(model, rows, "first").select(*FEATURES, "first"), "second")
    apart = F.col("first").isNull() | F.col("second").isNull() | (F.abs(F.col("first") - F.col("second")) > 1e-12)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(apart, 1)).alias("differing"))


# --- layer tables ----------------------------------------------------------------------------------------


@query(
    "s03_s12_layer_tables",
    """SELECT 'features.feature_values' AS layer_table, count(*) AS n, CAST(18 AS BIGINT) AS layer_tables FROM {offline}
       UNION ALL SELECT 'raw.equipment_data', count(*), 18 FROM {raw_equipment}""",
)
def s12(t):
    prefix = f"run_{uuid.uuid4().hex}_"  # databases of this run, in the shared folder, dropped at its end
    catalog.create_layers(t.spark, prefix, _folder(t, "layers"))
    try:
        made = sum(t.spark.catalog.tableExists(name) for name in catalog.layer_tables(prefix))
        filled = {"features.feature_values": t.offline, "raw.equipment_data": t.raw_equipment}
        counts = None
        for name, rows in filled.items():
            for _ in range(2):  # a second write replaces the first
                catalog.replace_table(rows, prefix + name)
            size = t.spark.table(prefix + name).agg(F.lit(name).alias("layer_table"), F.count(F.lit(1)).alias("n"))
            counts = size if counts is None else counts.unionByName(size)
        return cut_lineage(counts.withColumn("layer_tables", F.lit(made).cast("long")))
    finally:
        catalog.drop_layers(t.spark, prefix)


@query(
    "m18_metadata_upsert",
    f"""WITH old AS (SELECT equipment_id, max(value) AS top, min(reading_time) AS at FROM {{readings}}
                     WHERE reading_time < TIMESTAMP '2024-01-16 00:00:00' GROUP BY equipment_id),
             new AS (SELECT equipment_id, max(value) AS top, min(reading_time) AS at FROM {{readings}}
                     WHERE reading_time >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY equipment_id)
        SELECT coalesce(o.equipment_id, n.equipment_id) AS equipment_id, coalesce(n.top, o.top) AS top,
               coalesce(o.at, n.at) AS created_at,
               CASE WHEN n.equipment_id IS NULL THEN o.at ELSE TIMESTAMP '{LINES_NOW}' END AS updated_at
        FROM old o FULL JOIN new n ON o.equipment_id = n.equipment_id""",
    floats="top",
    times="created_at updated_at",
)
def m18(t):
    def state(rows):
        return rows.groupBy("equipment_id").agg(
            F.max("value").alias("top"), F.min("reading_time").alias("created_at"), F.min("reading_time").alias("updated_at")
        )

    late = F.col("reading_time") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    old, new = state(t.readings.filter(~late)), state(t.readings.filter(late))
    return tables.upsert_replace(old, new, ["equipment_id"], _now())


@query(
    "m20_touched_rows",
    f"""SELECT udi, CASE WHEN udi IN (SELECT udi FROM {{raw_equipment}} WHERE target = 1) THEN TIMESTAMP '{LINES_NOW}'
                         ELSE timestamp END AS updated_at FROM {{raw_equipment}}""",
    times="updated_at",
)
def m20(t):
    rows = t.raw_equipment.select("udi", F.col("timestamp").alias("updated_at"))
    return tables.touch_rows(rows, t.raw_equipment.filter("target = 1"), ["udi"], _now())


@query(
    "u06_retained_rows",
    f"""SELECT udi, timestamp FROM {{raw_equipment}} WHERE timestamp >= DATE '{LINES_NOW[:10]}' - INTERVAL '365' DAY""",
    times="timestamp",
)
def u06(t):
    return tables.retain(t.raw_equipment.select("udi", "timestamp"), "timestamp", _now(), 365)


@query(
    "u06_retention_drop",
    f"""SELECT 'raw' AS layer, CAST(timestamp AS DATE) AS day, count(*) AS before_rows,
               CASE WHEN CAST(timestamp AS DATE) >= DATE '{LINES_NOW[:10]}' - INTERVAL '365' DAY THEN count(*) ELSE 0 END AS after_rows
        FROM {{raw_equipment}} GROUP BY timestamp
        UNION ALL
        SELECT 'cleaned', CAST(cleaned_at AS DATE), count(*),
               CASE WHEN CAST(cleaned_at AS DATE) >= DATE '{LINES_NOW[:10]}' - INTERVAL '730' DAY THEN count(*) ELSE 0 END
        FROM {{cleaned}} GROUP BY cleaned_at""",
    dates="day",
)
def u06_drop(t):
    """Both layers as tables by month, old months dropped and the cut one rewritten: rows of each day before and after."""
    prefix = f"run_{uuid.uuid4().hex}"
    today = date.fromisoformat(LINES_NOW[:10])
    t.spark.sql(f"CREATE DATABASE {prefix} LOCATION '{_folder(t, 'retention')}'")
    try:
        counts = None
        for layer, rows, ts_col, days in (("raw", t.raw_equipment, "timestamp", 365), ("cleaned", t.cleaned, "cleaned_at", 730)):
            name = f"{prefix}.{layer}"
            catalog.create_dated_table(rows, name, ts_col, "month")
            by_day = F.to_date(ts_col).alias("day")
            sizes = [cut_lineage(t.spark.table(name).groupBy(by_day).agg(F.count(F.lit(1)).alias("n")))]
            catalog.drop_before(t.spark, name, today - timedelta(days=days), ts_col, "month")
            sizes.append(cut_lineage(t.spark.table(name).groupBy(by_day).agg(F.count(F.lit(1)).alias("n"))))
            both = sizes[0].withColumnRenamed("n", "before_rows").join(sizes[1].withColumnRenamed("n", "after_rows"), "day", "left")
            part = both.select(F.lit(layer).alias("layer"), "day", "before_rows", F.coalesce("after_rows", F.lit(0).cast("long")).alias("after_rows"))
            counts = part if counts is None else counts.unionByName(part)
        return counts
    finally:
        t.spark.sql(f"DROP DATABASE {prefix} CASCADE")


@query(
    "a11_daily_statistics_refreshed",
    """SELECT CAST(cleaned_at AS DATE) AS statistic_date, count(*) AS total_records,
              count(CASE WHEN is_valid THEN 1 END) AS valid_records, count(CASE WHEN NOT is_valid THEN 1 END) AS invalid_records,
              avg(air_temperature_k) AS avg_air_temp, avg(process_temperature_k) AS avg_process_temp,
              count(CASE WHEN target = 1 THEN 1 END) AS failure_count,
              round(100.0 * count(CASE WHEN target = 1 THEN 1 END) / count(*), 2) AS failure_rate_percent
       FROM {cleaned} GROUP BY 1""",
    floats="avg_air_temp avg_process_temp failure_rate_percent",
    dates="statistic_date",
    scale=9,
)
def a11_refreshed(t):
    """The stored summary after a late load: first all but the rows of some loads, then those rows and their months only."""
    prefix = f"run_{uuid.uuid4().hex}"
    late = (F.year("cleaned_at") == 2000) & F.col("udi").endswith("2")

    def daily(rows):
        return reports.daily_statistics(rows).withColumn("period", F.trunc("statistic_date", "MM"))

    t.spark.sql(f"CREATE DATABASE {prefix} LOCATION '{_folder(t, 'refresh')}'")
    try:
        source, summary = f"{prefix}.cleaned", f"{prefix}.daily_statistics"
        catalog.create_dated_table(t.cleaned.filter(~late), source, "cleaned_at", "month")
        daily(t.spark.table(source)).write.format("parquet").partitionBy("period").saveAsTable(summary)
        loaded = t.cleaned.filter(late).withColumn("period", catalog.period_of("cleaned_at", "month"))
        catalog.append_rows(loaded, source)
        touched = [r["period"] for r in loaded.select("period").distinct().collect()]
        catalog.refresh_periods(t.spark, source, summary, touched, daily)
        return cut_lineage(t.spark.table(summary).drop("period"))
    finally:
        t.spark.sql(f"DROP DATABASE {prefix} CASCADE")


# --- registry --------------------------------------------------------------------------------------------


def _definitions(t, name: str = "sensor"):
    """A registry definition for every kind of reading, its limits taken from the readings."""
    found = t.readings.groupBy(F.col(name).alias("feature_name")).agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    values = {
        "feature_type": F.lit("numeric"),
        "description": F.lit(""),
        "source": F.lit("readings"),
        "transformations": F.array(F.lit("standard_scaler"), F.lit("binning")),
        "allowed_values": F.array().cast("array<string>"),
        "owners": F.array(F.lit("operations")),
        "created_at": _now(),
        "updated_at": F.lit(None).cast("timestamp_ntz"),
        "version": F.lit(1),
    }
    return found.withColumns(values).select(*store.REGISTRY_SCHEMA.fieldNames())


@query(
    "m14_registry_life_cycle",
    f"""SELECT sensor AS feature_name, 'numeric' AS feature_type, min(value) AS min_value,
               CASE WHEN sensor = 'click' THEN 1000.0 ELSE max(value) END AS max_value,
               CASE WHEN sensor = 'click' THEN 2 ELSE 1 END AS version,
               CASE WHEN sensor = 'click' THEN TIMESTAMP '{LINES_NOW}' END AS updated_at
        FROM {{readings}} WHERE sensor <> 'view' GROUP BY sensor""",
    floats="min_value max_value",
    times="updated_at",
)
def m14(t):
    known = _definitions(t)
    renewed = known.withColumn("feature_type", F.lit("numeric"))
    registry = store.register(known.withColumn("feature_type", F.lit("text")), renewed)
    registry = store.update_definition(registry, "click", {"max_value": F.lit(1000.0)}, _now())
    registry = store.unregister(registry, "view")
    columns = ["feature_name", "feature_type", "min_value", "max_value", "version", "updated_at"]
    return store.of_type(registry, "numeric").select(*columns)


@query(
    "m15_registry_export",
    f"""SELECT equipment_id AS feature_name, '["standard_scaler","binning"]' AS transformations, '["operations"]' AS owners,
               1 AS version, TIMESTAMP '{LINES_NOW}' AS updated_at FROM {{readings}} GROUP BY equipment_id""",
    times="updated_at",
)
def m15(t):
    path = _folder(t, "registry")
    _definitions(t, "equipment_id").write.json(path)
    loaded = t.spark.read.schema(store.REGISTRY_SCHEMA).json(path)
    flat = store.registry_export(loaded)
    merged = tables.upsert_replace(flat, flat, ["feature_name"], _now())
    return merged.select("feature_name", "transformations", "owners", "version", "updated_at")


# --- profiles and messages -------------------------------------------------------------------------------


@query(
    "a45_history_statistics",
    """SELECT equipment_id, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max,
              count(value) AS count FROM {readings} GROUP BY equipment_id""",
    floats="mean std min max",
)
def a45(t):
    return profiling.history_statistics(t.readings, "value", ["equipment_id"])


@query(
    "w10_share_of_total",
    """SELECT failure_type, count(*) AS count, count(*) * 1.0::DOUBLE / sum(count(*)) OVER () AS share
       FROM {raw_equipment} GROUP BY failure_type""",
    floats="share",
    scale=9,
)
def w10(t):
    return profiling.value_shares(t.raw_equipment, "failure_type")


@query(
    "x02_numeric_members",
    """SELECT message_id, 'temperature' AS sensor, temperature AS value FROM {sensor_messages} WHERE temperature IS NOT NULL
       UNION ALL SELECT message_id, 'vibration', vibration FROM {sensor_messages} WHERE vibration IS NOT NULL""",
    floats="value",
)
def x02(t):
    rows = t.spark.sql(VIEWS["sensor_messages"], lineitem=_stream(t, "lineitem"))
    members = F.struct(
        "temperature", "vibration", (F.col("vibration") > 50).alias("high"), F.col("pressure").cast("string").alias("pressure")
    )
    at = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")
    # the message id stands for the entity, so that every message can be told apart
    text = rows.select(F.to_json(F.struct(F.col("message_id").alias("equipment_id"), at, members.alias("data"))).alias("value"))
    found = _collect(t, messages.series(messages.parse(text)))
    return found.select(F.col("equipment_id").alias("message_id"), "sensor", "value")
