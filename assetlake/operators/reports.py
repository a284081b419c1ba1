"""Monitoring queries, rankings and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.functions.numeric import count_where, percent
from assetlake.functions.text import json_text
from assetlake.functions.tiers import risk_category, risk_score, severity_rank, trend_arrow
from assetlake.operators.joins import production_only
from assetlake.operators.tables import latest_per_entity, latest_per_key


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.expr(f"INTERVAL '{days}' DAY")


def daily_prediction_statistics(predictions: DataFrame, models: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = production_only(predictions.filter(F.col("prediction_timestamp") >= days_before(as_of, days)), models)
    return recent.groupBy(F.to_date("prediction_timestamp").alias("prediction_date")).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        count_where(F.col("predicted") == 1).alias("positive_predictions"),
        count_where(F.col("actual") == 1).alias("actual_failures"),
        F.avg("failure_probability").alias("avg_failure_probability"),
        F.avg("inference_time_ms").alias("avg_inference_time_ms"),
    )


def daily_statistics(cleaned: DataFrame, ts_col: str = "cleaned_at") -> DataFrame:
    failed = count_where(F.col("target") == 1)
    return cleaned.groupBy(F.to_date(ts_col).alias("statistic_date")).agg(
        F.count(F.lit(1)).alias("total_records"),
        count_where(F.col("is_valid")).alias("valid_records"),
        count_where(~F.col("is_valid")).alias("invalid_records"),
        F.avg("air_temperature_k").alias("avg_air_temp"),
        F.avg("process_temperature_k").alias("avg_process_temp"),
        failed.alias("failure_count"),
        percent(failed, F.count(F.lit(1))).alias("failure_rate_percent"),
    )


def equipment_risk(predictions: DataFrame, models: DataFrame, equipment_id: str | None = None) -> DataFrame:
    """Risk category and score from the latest production prediction of one or every asset."""
    scope = predictions if equipment_id is None else predictions.filter(F.col("equipment_id") == equipment_id)
    newest = latest_per_key(
        production_only(scope, models).select(
            "equipment_id", "prediction_timestamp", "prediction_id", "failure_probability", "predicted"
        ),
        ["equipment_id"],
        ["prediction_timestamp", "prediction_id"],
    )
    return newest.select(
        "equipment_id",
        risk_category("failure_probability").alias("risk_category"),
        "failure_probability",
        F.col("prediction_timestamp").alias("last_prediction"),
        risk_score("failure_probability", "predicted").alias("risk_score"),
    )


def top_risky_recent(predictions, models, equipment, since: Column, limit: int = 10) -> DataFrame:
    """Highest recent failure probabilities with equipment columns; ranked after the top-k cut."""
    recent = predictions.filter((F.col("prediction_timestamp") >= since) & (F.col("predicted") == 1))
    joined = production_only(recent, models).join(equipment, "equipment_id")
    top = joined.orderBy(F.col("failure_probability").desc(), "equipment_id", "prediction_id").limit(limit)
    rank = F.rank().over(Window.orderBy(F.col("failure_probability").desc()))  # over `limit` rows
    return top.select(
        "equipment_id",
        "equipment_type",
        "tool_wear_min",
        "torque_nm",
        "failure_probability",
        "prediction_timestamp",
        rank.alias("risk_rank"),
    )


def top_risky_equipment(
    predictions, models, equipment, first_seen, as_of: Column, limit: int = 10, min_probability: float = 0.3
) -> DataFrame:
    """Latest positive production prediction per asset, most probable first.

    ``first_seen``: equipment_id, feature_date (several rows per asset allowed).
    """
    positive = production_only(
        predictions.filter((F.col("predicted") == 1) & (F.col("failure_probability") >= min_probability)), models
    ).select("equipment_id", "prediction_timestamp", "prediction_id", "failure_probability")
    newest = latest_per_entity(positive, "equipment_id", ["prediction_timestamp", "prediction_id"])
    since = first_seen.groupBy("equipment_id").agg(F.min("feature_date").alias("_first"))
    top = (
        newest.join(equipment.select("equipment_id", "equipment_type", "tool_wear_min"), "equipment_id")
        .orderBy(F.col("failure_probability").desc(), "equipment_id")
        .limit(limit)
    )
    return top.join(since, "equipment_id", "left").select(
        "equipment_id",
        "equipment_type",
        "failure_probability",
        risk_category("failure_probability").alias("risk_category"),
        F.col("tool_wear_min").alias("tool_wear"),
        F.datediff(as_of, F.col("_first")).alias("last_maintenance_days"),
    )


def maintenance_priority(risk: DataFrame, wear: DataFrame, ages: DataFrame) -> DataFrame:
    """5 * risk score + least(wear, 300) div 3 + 2 * days since the first feature row, per asset."""
    joined = risk.select("equipment_id", "risk_score").join(wear, "equipment_id").join(ages, "equipment_id", "left")
    worn = F.floor(F.least(F.col("tool_wear_min"), F.lit(300)) / 3).cast("long")
    days = F.coalesce(F.col("age_days"), F.lit(0))
    return joined.select(
        "equipment_id",
        "risk_score",
        "tool_wear_min",
        days.alias("days"),
        (F.col("risk_score") * 5 + worn + days * 2).alias("priority"),
    )


def open_alerts_by_severity(alerts: DataFrame, as_of: Column) -> DataFrame:
    """Unresolved alerts, most severe and newest first, with their age in seconds."""
    return (
        alerts.filter(~F.col("is_resolved"))
        .withColumn("severity_rank", severity_rank("alert_severity"))
        .withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("created_at"), as_of))
        .orderBy(F.col("severity_rank").asc_nulls_last(), F.col("created_at").desc(), "alert_id")
    )


def latest_imports(imports: DataFrame, limit: int = 10) -> DataFrame:
    latest = imports.orderBy(F.col("started_at").desc(), "file_name").limit(limit)
    return latest.withColumn("duration", F.col("completed_at") - F.col("started_at"))


def active_models(models: DataFrame, limit: int = 5) -> DataFrame:
    """Newest active models with their metrics read out of the JSON column."""
    newest = models.filter("is_active").orderBy(F.col("training_date").desc(), "model_id").limit(limit)
    members = {m: json_text("performance_metrics", m) for m in ("recall", "fpr", "precision", "auc_roc")}
    return newest.withColumns(members)


def daily_report(cleaned: DataFrame, metrics: DataFrame, report_date: str, ts_col: str = "created_at") -> DataFrame:
    """(metric_name, metric_value, metric_trend) of one day; the trend compares with the previous day on record."""
    days = cleaned.groupBy(F.to_date(ts_col).alias("day")).agg(
        F.count(F.lit(1)).alias("processed"),
        count_where(F.col("is_valid")).alias("valid"),
        F.sum("target").alias("failures"),
    )
    target = F.lit(report_date).cast("date")
    # the previous day on record is the newest one before the report date: two small aggregates, no global window
    today = days.filter(F.col("day") == target).agg(F.max(F.struct("processed", "valid", "failures")).alias("t"))
    before = days.filter(F.col("day") < target).agg(F.max_by(F.struct("processed", "failures"), "day").alias("b"))
    recall = metrics.filter((F.col("metric_date") == target) & (F.col("metric_name") == "recall")).agg(
        F.max("metric_value").alias("r")
    )
    row = today.withColumn("b", before.scalar()).withColumn("r", recall.scalar())
    quality = percent(F.col("t.valid"), F.col("t.processed"), 1)
    steady = F.lit("→")

    def line(name, value, trend):
        return F.struct(F.lit(name).alias("metric_name"), value.cast("string").alias("metric_value"), trend.alias("metric_trend"))

    return row.select(
        F.inline(
            F.array(
                line("Processed Records", F.coalesce("t.processed", F.lit(0)), trend_arrow("t.processed", "b.processed")),
                line("Data Quality (%)", quality, steady),
                line("Failure Count", F.col("t.failures"), trend_arrow("t.failures", "b.failures")),
                line("Model Recall (%)", F.round(F.col("r") * 100, 1), steady),
            )
        )
    )


def batch_summary(predictions: DataFrame, batch_col: str = "batch_id", p_col: str = "failure_probability") -> DataFrame:
    """Per batch: requests, scored, failed and the scoring time in total and on average."""
    scored = F.count(p_col)
    return predictions.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("total_requests"),
        scored.alias("successful"),
        (F.count(F.lit(1)) - scored).alias("failed"),
        F.sum("inference_time_ms").alias("total_inference_time_ms"),
        F.try_divide(F.sum("inference_time_ms"), F.greatest(scored, F.lit(1))).alias("avg_inference_time_ms"),
    )


def latest_wear(cleaned: DataFrame, entity: str = "equipment_id", ts_col: str = "cleaned_at") -> DataFrame:
    return latest_per_key(cleaned.select(entity, ts_col, "tool_wear_min"), [entity], [ts_col, "tool_wear_min"]).select(
        entity, "tool_wear_min"
    )


def head_sample(df: DataFrame, order_by, rows: int = 100) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


