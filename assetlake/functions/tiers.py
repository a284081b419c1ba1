"""Decision, alert, risk and category tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assetlake.functions.numeric import _col

# Recommendation texts and tier bounds of the scoring responses.
RECOMMEND_REPAIR = "НЕМЕДЛЕННЫЙ РЕМОНТ - высокая вероятность отказа"
RECOMMEND_SERVICE = "ПЛАНОВОЕ ОБСЛУЖИВАНИЕ - рекомендуется проверить оборудование"
RECOMMEND_WATCH = "МОНИТОРИНГ - увеличен риск отказа"
RECOMMEND_NONE = "НОРМАЛЬНАЯ РАБОТА - оборудование в хорошем состоянии"
SHORT_REPAIR = "НЕМЕДЛЕННЫЙ РЕМОНТ"
SHORT_SERVICE = "ПЛАНОВОЕ ОБСЛУЖИВАНИЕ"
SHORT_NONE = "НОРМАЛЬНАЯ РАБОТА"

# Cut points and scores of the risk categories.
RISK_TIERS = ((0.7, "CRITICAL", 100), (0.5, "HIGH", 75), (0.3, "MEDIUM", 50))


def _ladder(steps, default) -> Column:
    """First matching (condition, result) pair, else the default."""
    result = None
    for condition, value in steps:
        result = F.when(condition, F.lit(value)) if result is None else result.when(condition, F.lit(value))
    return result.otherwise(F.lit(default))


def decide(p, threshold=0.5, strict: bool = False) -> Column:
    """1 when the probability reaches the threshold (``strict``: exceeds it), else 0."""
    p, threshold = _col(p), threshold if isinstance(threshold, Column) else F.lit(threshold)
    hit = p > threshold if strict else p >= threshold
    return hit.cast("int")


def confidence(p, decision) -> Column:
    """Probability of the class that was decided for."""
    p = _col(p)
    return F.when(_col(decision) == 1, p).otherwise(F.lit(1.0) - p)


def class_label(decision, positive: str = "FAILURE", negative: str = "NORMAL") -> Column:
    return F.when(_col(decision) == 1, F.lit(positive)).otherwise(F.lit(negative))


def alert_level(p) -> Column:
    p = _col(p)
    return _ladder([(p >= 0.8, "critical"), (p >= 0.4, "warning")], "normal")


def recommendation(p) -> Column:
    p = _col(p)
    return _ladder(
        [(p >= 0.8, RECOMMEND_REPAIR), (p >= 0.6, RECOMMEND_SERVICE), (p >= 0.4, RECOMMEND_WATCH)],
        RECOMMEND_NONE,
    )


def recommendation_three_tier(p) -> Column:
    p = _col(p)
    return _ladder([(p > 0.8, SHORT_REPAIR), (p > 0.5, SHORT_SERVICE)], SHORT_NONE)


def risk_category(p) -> Column:
    p = _col(p)
    return _ladder([(p > cut, name) for cut, name, _ in RISK_TIERS], "LOW")


def risk_score(p, predicted) -> Column:
    p = _col(p)
    scored = _ladder([(p > cut, score) for cut, _, score in RISK_TIERS], 25)
    return F.when(_col(predicted) == 1, scored).otherwise(F.lit(0))


def drift_severity(score, threshold) -> Column:
    score, threshold = _col(score), _col(threshold)
    return _ladder([(score > threshold * 1.5, "HIGH"), (score > threshold, "MEDIUM")], "LOW")


def wear_category(wear, upper_inclusive: bool = True) -> Column:
    """low below 50, medium up to 150, high above; 150 itself is medium only if ``upper_inclusive``."""
    wear = _col(wear)
    medium = wear <= 150 if upper_inclusive else wear < 150
    return _ladder([(wear < 50, "low"), (medium, "medium"), (wear.isNotNull(), "high")], "unknown")


def severity_rank(severity) -> Column:
    severity = _col(severity)
    order = ("critical", "high", "medium", "low")
    return _ladder([(severity == name, i + 1) for i, name in enumerate(order)], None)


def error_type(predicted, actual) -> Column:
    predicted, actual = _col(predicted), _col(actual)
    label = _ladder(
        [(predicted == actual, "Correct"), ((predicted == 1) & (actual == 0), "False Positive")],
        "False Negative",
    )
    return F.when(predicted.isNotNull() & actual.isNotNull(), label)


def trend_arrow(current, previous) -> Column:
    current, previous = _col(current), _col(previous)
    return _ladder([(current > previous, "↑"), (current < previous, "↓")], "→")


def encode_ordinal(value, order, default=None) -> Column:
    """Position of the value in ``order``; anything else gives ``default``."""
    value = _col(value)
    return _ladder([(value == name, i) for i, name in enumerate(order)], default)
