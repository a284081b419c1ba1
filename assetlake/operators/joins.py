"""Joins of facts, dimensions and feature stores.

No side is hinted for broadcast: Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.operators.ordering import match_on
from assetlake.operators.tables import latest_per_entity


def production_only(predictions: DataFrame, models: DataFrame) -> DataFrame:
    """Predictions of production models (semi-join)."""
    return predictions.join(models.filter("is_production").select("model_id"), "model_id", "left_semi")


def current_predictions(predictions: DataFrame, models: DataFrame) -> DataFrame:
    production = models.filter("is_production").select("model_id", "model_name", "model_version")
    return predictions.join(production, "model_id").select(
        "equipment_id", "prediction_timestamp", "failure_probability", "predicted", "model_name", "model_version"
    )


def with_equipment(facts: DataFrame, equipment: DataFrame, columns: Sequence[str]) -> DataFrame:
    return facts.join(equipment.select("equipment_id", *columns), "equipment_id", "inner")


def quality_report(daily: DataFrame, metrics: DataFrame, production: DataFrame | None = None) -> DataFrame:
    """Daily statistics with the day's recall and precision, 0 where none was recorded."""
    if production is not None:
        metrics = metrics.join(production.select("model_id"), "model_id", "left_semi")
    wide = pivot_metrics(metrics, ["recall", "precision"]).withColumnRenamed("metric_date", "statistic_date")
    joined = match_on(daily, wide, ["statistic_date"])
    return joined.withColumns(
        {
            "model_recall": F.coalesce("recall", F.lit(0.0)),
            "model_precision": F.coalesce("precision", F.lit(0.0)),
        }
    ).drop("recall", "precision")


def pivot_metrics(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long metric rows to one row per date with a column per name."""
    return metrics.groupBy("metric_date").pivot("metric_name", list(names)).agg(F.max("metric_value"))


def equipment_health(equipment, readings, predictions, open_alerts) -> DataFrame:
    """Every asset with its latest reading, latest prediction and its unresolved alerts."""
    reading = latest_per_entity(readings, "equipment_id", ["reading_time", "reading_id"])
    prediction = latest_per_entity(predictions, "equipment_id", ["prediction_timestamp", "prediction_id"])
    return (
        equipment.join(reading, "equipment_id", "left")
        .join(prediction, "equipment_id", "left")
        .join(open_alerts, "equipment_id", "left")
    )


def unknown_entities(df: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the master, with the error text."""
    return df.join(master.select(key).distinct(), key, "left_anti").withColumn("error", F.lit("not found"))


def orphan_counts(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Foreign-key report: (name, child, child key, parent, parent key) -> rows without a parent."""
    out = None
    for name, child, child_key, parent, parent_key in relations:
        keys = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        missing = keys.join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
        row = missing.agg(
            F.lit(name).alias("relation"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def resolve_outcomes(predictions: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """Fill ``actual`` and ``is_correct`` once the outcome of a prediction is known."""
    joined = predictions.join(outcomes.select(key, "outcome"), key, "left")
    actual = F.col("outcome")
    return joined.withColumns({"actual": actual, "is_correct": F.col("predicted") == actual}).drop("outcome")


def serve_features(
    requested: DataFrame,
    online: DataFrame,
    offline: DataFrame,
    names: Sequence[str],
    as_of: Column,
    max_age_minutes: int | None = 5,
    lookback_hours: int = 24,
) -> DataFrame:
    """Features per requested entity: fresh online values, else the newest offline row, else nothing.

    ``online``: equipment_id, features map, timestamp, ingestion_time. ``offline``: long feature rows.
    ``max_age_minutes=None`` takes online values of any age (the batch lookup).
    """
    wanted = list(names)
    age = F.timestamp_diff("SECOND", F.col("ingestion_time"), as_of)
    fresh = F.lit(True) if max_age_minutes is None else age < max_age_minutes * 60
    cached = online.select(
        "equipment_id",
        F.map_filter("features", lambda k, _: k.isin(wanted)).alias("online_features"),
        F.col("timestamp").alias("online_timestamp"),
        fresh.alias("online_fresh"),
    )
    start = as_of - F.expr(f"INTERVAL '{lookback_hours}' HOUR")
    recent = offline.filter(
        F.col("feature_name").isin(wanted) & (F.col("timestamp") >= start) & (F.col("timestamp") <= as_of)
    )
    rows = recent.groupBy("equipment_id", "timestamp").agg(
        F.map_from_entries(F.collect_set(F.struct("feature_name", "feature_value"))).alias("features")
    )
    newest = rows.groupBy("equipment_id").agg(
        F.max("timestamp").alias("offline_timestamp"), F.max_by("features", "timestamp").alias("offline_features")
    )
    use_online = F.coalesce(F.col("online_fresh"), F.lit(False))
    has_offline = F.col("offline_timestamp").isNotNull()
    none = F.create_map().cast("map<string,double>")
    return (
        requested.join(cached, "equipment_id", "left")
        .join(newest, "equipment_id", "left")
        .select(
            "equipment_id",
            F.when(use_online, F.col("online_features"))
            .when(has_offline, F.map_filter("offline_features", lambda _, v: v.isNotNull()))
            .otherwise(none)
            .alias("features"),
            F.when(use_online, F.lit("online_store"))
            .when(has_offline, F.lit("offline_store"))
            .otherwise(F.lit("none"))
            .alias("source"),
            F.when(use_online, F.col("online_timestamp"))
            .when(has_offline, F.col("offline_timestamp"))
            .alias("timestamp"),
            use_online.alias("fresh"),
        )
    )
