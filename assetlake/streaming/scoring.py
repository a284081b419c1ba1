"""Scoring of a sensor stream and reuse of each entity's last result."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.learning.models import score_batch
from assetlake.operators.tables import latest_per_key


def score_stream(model: Transformer, sensor_rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Predictions with tiers for every row of a stream (stateless, so any output mode works)."""
    return score_batch(model, sensor_rows, threshold)


def linear_predictor(model: PipelineModel) -> Callable[[Sequence[float]], float]:
    """Probability of one row of features by a fitted logistic regression, for use in a state processor."""
    scaler, fitted = model.stages[-2], model.stages[-1]
    weights = [float(w) / float(d) if d else 0.0 for w, d in zip(fitted.coefficients, scaler.std)]
    bias = float(fitted.intercept) - sum(w * float(m) for w, m in zip(weights, scaler.mean))

    def predict(row: Sequence[float]) -> float:
        margin = bias + sum(w * x for w, x in zip(weights, row))
        return 1 / (1 + math.exp(-margin)) if margin >= 0 else math.exp(margin) / (1 + math.exp(margin))

    return predict


def last_results(predictions: DataFrame) -> DataFrame:
    """Newest stored prediction per entity."""
    return latest_per_key(predictions, ["equipment_id"], ["event_time", "failure_probability"])


def with_cached(requests: DataFrame, cached: DataFrame, as_of: Column, max_age_minutes: int = 5) -> tuple[DataFrame, DataFrame]:
    """(requests answered by a result that is young enough, requests that need scoring)."""
    young = cached.filter(F.col("event_time") > as_of - F.expr(f"INTERVAL '{max_age_minutes}' MINUTE"))
    hits = requests.join(young.select("equipment_id", "failure_probability", "predicted_failure"), "equipment_id")
    return hits, requests.join(young.select("equipment_id"), "equipment_id", "left_anti")
