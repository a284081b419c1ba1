"""Classifier evaluation from (actual, predicted, probability) columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.functions.numeric import count_where, percent, safe_divide
from assetlake.functions.tiers import error_type
from assetlake.operators.ordering import match_on, running_totals

# Business targets, costs and the no-system baseline.
RECALL_TARGET = 0.85
FPR_TARGET = 0.15
COST_FALSE_POSITIVE = 5000
COST_FALSE_NEGATIVE = 15000
SAVING_TRUE_POSITIVE = 10000
BASE_FALSE_POSITIVE_SHARE = 0.38
BASE_FALSE_NEGATIVE_SHARE = 0.10

# Changes that raise a monitoring alert.
MONITOR_LIMITS = {"recall_drop": 0.02, "fpr_increase": 0.03, "data_drift": 0.25, "inference_time": 60.0}


def _outcome(actual: int, predicted: int):
    return count_where((F.col("actual") == actual) & (F.col("predicted") == predicted))


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and rates per group; a zero denominator gives 0."""
    known = df.filter(F.col("actual").isNotNull())
    counts = known.groupBy(*by).agg(
        _outcome(1, 1).alias("true_positives"),
        _outcome(0, 1).alias("false_positives"),
        _outcome(0, 0).alias("true_negatives"),
        _outcome(1, 0).alias("false_negatives"),
    )
    return rates_from_counts(counts)


def rates_from_counts(counts: DataFrame) -> DataFrame:
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    return counts.withColumns(
        {
            "accuracy": safe_divide(tp + tn, tp + tn + fp + fn, 0.0),
            "precision": safe_divide(tp, tp + fp, 0.0),
            "recall": safe_divide(tp, tp + fn, 0.0),
            "f1_score": safe_divide(2 * tp, 2 * tp + fp + fn, 0.0),
            "false_positive_rate": safe_divide(fp, fp + tn, 0.0),
            "true_negative_rate": safe_divide(tn, tn + fp, 0.0),
        }
    )


def meets_targets(metrics: DataFrame, recall: float = RECALL_TARGET, fpr: float = FPR_TARGET) -> DataFrame:
    return metrics.withColumns(
        {
            "recall_pass": F.col("recall") >= recall,
            "fpr_pass": F.col("false_positive_rate") < fpr,
            "business_pass": (F.col("recall") >= recall) & (F.col("false_positive_rate") < fpr),
        }
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("actual").isNotNull())
        .groupBy("actual")
        .agg(
            count_where(F.col("predicted") == 0).alias("predicted_0"),
            count_where(F.col("predicted") == 1).alias("predicted_1"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def class_report(df: DataFrame) -> DataFrame:
    """precision, recall, f1 and support of every class that occurs as actual or predicted."""
    pairs = df.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    hits = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0).cast("long"))
    roles = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"), hits.alias("hit")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    summed = roles.groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit")
    )
    return summed.select(
        "class",
        safe_divide("hit", "claimed", 0.0).alias("precision"),
        safe_divide("hit", "support", 0.0).alias("recall"),
        safe_divide(2 * F.col("hit"), F.col("support") + F.col("claimed"), 0.0).alias("f1_score"),
        "support",
    )


# --- curves ----------------------------------------------------------------------------------------------


def _score_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores, highest first, with running positives and negatives and the group totals."""
    known = df.filter(F.col("actual").isNotNull() & F.col("p").isNotNull())
    scores = known.groupBy(*by, "p").agg(
        count_where(F.col("actual") == 1).alias("pos"), count_where(F.col("actual") == 0).alias("neg")
    )
    totals = known.groupBy(*by).agg(
        count_where(F.col("actual") == 1).alias("total_pos"), count_where(F.col("actual") == 0).alias("total_neg")
    )
    cumulated = running_totals(scores, "p", ["pos", "neg"], by, descending=True)
    if by:
        return match_on(cumulated, totals, by)
    return cumulated.withColumn("_t", totals.select(F.struct("*")).scalar()).select("*", "_t.*").drop("_t")


def roc_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score: classify as positive everything at or above it."""
    return _score_totals(df, by).select(
        *by,
        F.col("p").alias("threshold"),
        safe_divide("cum_neg", "total_neg").alias("fpr"),
        safe_divide("cum_pos", "total_pos").alias("tpr"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over distinct scores."""
    step = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    area = _score_totals(df, by).groupBy(*by).agg(
        F.sum(step).alias("_area"), F.max("total_pos").alias("_p"), F.max("total_neg").alias("_n")
    )
    return area.select(*by, safe_divide("_area", F.col("_p") * F.col("_n")).alias("auc"))


def precision_recall_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    points = _score_totals(df, by)
    precision = safe_divide("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    recall = safe_divide("cum_pos", "total_pos")
    return points.select(
        *by,
        F.col("p").alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_divide("cum_neg", "total_neg", 0.0).alias("fpr"),
        (2 * precision * recall / (precision + recall + F.lit(1e-10))).alias("f1"),
    )


def average_precision(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    points = _score_totals(df, by)
    step = safe_divide("pos", "total_pos") * safe_divide("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    return points.groupBy(*by).agg(F.sum(step).alias("average_precision"))


def best_f1_threshold(df: DataFrame, min_recall: float | None = None, max_fpr: float | None = None) -> DataFrame:
    """Observed score with the best F1 (the lowest on ties), under constraints; 0.5 if none qualifies."""
    curve = precision_recall_curve(df)
    if min_recall is not None:
        curve = curve.filter((F.col("recall") >= min_recall) & (F.col("fpr") <= max_fpr))
    best = curve.agg(
        F.max_by(F.struct("threshold", "recall", "fpr", "f1"), F.struct("f1", -F.col("threshold"))).alias("b")
    )
    return best.select(
        F.coalesce(F.col("b.threshold"), F.lit(0.5)).alias("threshold"),
        F.col("b.recall").alias("recall"),
        F.col("b.fpr").alias("fpr"),
        F.col("b.f1").alias("f1"),
        F.col("b").isNotNull().alias("found"),
    )


def threshold_sweep(df: DataFrame, min_recall=RECALL_TARGET, max_fpr=FPR_TARGET) -> DataFrame:
    """recall, fpr and score at the thresholds 0.10, 0.11 ... 0.90.

    Each row is counted once, under the highest threshold it reaches; the 81 tallies are then cumulated.
    """
    near = F.floor(F.col("p") * 100)  # corrected so that slot k holds exactly the scores with k/100 <= p
    near = F.when(F.col("p") >= (near + 1) / 100, near + 1).when(F.col("p") < near / 100, near - 1).otherwise(near)
    slot = F.greatest(F.least(near.cast("int"), F.lit(90)), F.lit(9))
    tallies = (
        df.filter(F.col("actual").isNotNull() & F.col("p").isNotNull())
        .groupBy(slot.alias("slot"))
        .agg(count_where(F.col("actual") == 1).alias("pos"), count_where(F.col("actual") == 0).alias("neg"))
    )
    packed = tallies.agg(F.collect_list(F.struct("slot", "pos", "neg")).alias("t"))  # at most 82 entries

    def at_or_above(member):
        kept = F.filter("t", lambda x: x["slot"] >= F.col("step"))
        return F.aggregate(kept, F.lit(0).cast("long"), lambda acc, x: acc + x[member])

    def everything(member):
        return F.aggregate("t", F.lit(0).cast("long"), lambda acc, x: acc + x[member])

    swept = packed.select("t", F.explode(F.sequence(F.lit(10), F.lit(90))).alias("step")).select(
        (F.col("step") / 100).alias("threshold"),
        safe_divide(at_or_above("pos"), everything("pos"), 0.0).alias("recall"),
        safe_divide(at_or_above("neg"), everything("neg"), 0.0).alias("fpr"),
    )
    passed = (F.col("recall") >= min_recall) & (F.col("fpr") <= max_fpr)
    return swept.withColumn("business_pass", passed).withColumn(
        "custom_score", F.when(passed, F.col("recall") * (1 - F.col("fpr"))).otherwise(F.lit(-1.0))
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """First threshold with the best score; 0.5 when none meets the constraints."""
    best = sweep.filter("business_pass").agg(
        F.max_by("threshold", F.struct("custom_score", -F.col("threshold"))).alias("t"),
        F.max("custom_score").alias("score"),
    )
    return best.select(
        F.coalesce("t", F.lit(0.5)).alias("threshold"), F.coalesce("score", F.lit(-1.0)).alias("custom_score")
    )


def calibration_curve(df: DataFrame, bins: int = 10) -> DataFrame:
    slot = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col("actual").isNotNull())
        .groupBy(slot.alias("bin"))
        .agg(
            F.avg("p").alias("mean_predicted"),
            F.avg(F.col("actual").cast("double")).alias("fraction_positive"),
            F.count(F.lit(1)).alias("count"),
        )
    )


# --- business --------------------------------------------------------------------------------------------


def business_value(metrics: DataFrame, total_units: int = 100) -> DataFrame:
    """Cost, savings and return against the no-system baseline, from confusion counts."""
    cost = F.col("false_positives") * COST_FALSE_POSITIVE + F.col("false_negatives") * COST_FALSE_NEGATIVE
    base = (
        total_units * BASE_FALSE_POSITIVE_SHARE * COST_FALSE_POSITIVE
        + total_units * BASE_FALSE_NEGATIVE_SHARE * COST_FALSE_NEGATIVE
    )
    saved = F.col("true_positives") * SAVING_TRUE_POSITIVE
    out = metrics.withColumns(
        {
            "cost_with_system": cost.cast("double"),
            "cost_without_system": F.lit(float(base)),
            "savings_from_prevention": saved.cast("double"),
        }
    )
    out = out.withColumn(
        "total_savings",
        F.col("cost_without_system") - F.col("cost_with_system") + F.col("savings_from_prevention"),
    )
    share = safe_divide(F.col("total_savings") * 100, "cost_with_system", 0.0)
    return out.withColumn("roi_percentage", F.when(F.col("cost_with_system") > 0, share).otherwise(F.lit(0.0)))


def with_error_type(df: DataFrame) -> DataFrame:
    return df.withColumn("error_type", error_type("predicted", "actual"))


def error_profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature means per error type."""
    labelled = with_error_type(df).filter(F.col("error_type").isNotNull())
    return labelled.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("count"), *[F.avg(c).alias(f"avg_{c}") for c in features]
    )


def missed_versus_caught(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean of every feature among missed and caught failures and their difference, in one pass."""
    missed = (F.col("actual") == 1) & (F.col("predicted") == 0)
    caught = (F.col("actual") == 1) & (F.col("predicted") == 1)
    aggs = []
    for c in features:
        aggs += [F.avg(F.when(missed, F.col(c))).alias(f"fn_{c}"), F.avg(F.when(caught, F.col(c))).alias(f"tp_{c}")]
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"fn_{c}").alias("missed_mean"),
                F.col(f"tp_{c}").alias("caught_mean"),
                (F.col(f"fn_{c}") - F.col(f"tp_{c}")).alias("difference"),
            )
            for c in features
        ]
    )
    return df.agg(*aggs).select(F.inline(entries))


def compare_models(df: DataFrame, model_col: str = "model_id") -> DataFrame:
    """Metrics per model with the candidate flag and the fallback score recall * (1 - fpr)."""
    return meets_targets(classification_metrics(df, [model_col])).withColumn(
        "custom_score", F.col("recall") * (1 - F.col("false_positive_rate"))
    )


def choose_model(comparison: DataFrame, model_col: str = "model_id") -> DataFrame:
    """Best recall among candidates, otherwise the best fallback score; ties go to the smaller id."""
    picked = comparison.agg(
        F.min_by(
            F.struct(model_col, "recall", "false_positive_rate", "custom_score", "business_pass"),
            F.struct(
                ~F.col("business_pass"),
                F.when(F.col("business_pass"), -F.col("recall")).otherwise(-F.col("custom_score")),
                F.col(model_col),
            ),
        ).alias("m")
    )
    return picked.select("m.*")


def ab_comparison(predictions: DataFrame, tests: DataFrame) -> DataFrame:
    """Recall, false-positive rate and sample size of control and treatment within each test's dates.

    ``tests``: test_id, control_model_id, treatment_model_id, start_date, end_date (NULL = open).
    """
    arms = tests.select(
        "test_id",
        "start_date",
        "end_date",
        F.inline(
            F.array(
                F.struct(F.col("control_model_id").alias("model_id"), F.lit("control").alias("arm")),
                F.struct(F.col("treatment_model_id").alias("model_id"), F.lit("treatment").alias("arm")),
            )
        ),
    )
    day = F.to_date("prediction_timestamp")
    joined = predictions.join(arms, "model_id").filter(
        (day >= F.col("start_date")) & (F.col("end_date").isNull() | (day <= F.col("end_date")))
    )
    scored = classification_metrics(joined, ["test_id", "arm"])
    size = sum(F.col(c) for c in ("true_positives", "false_positives", "true_negatives", "false_negatives"))

    def arm(column, name):
        return F.max(F.when(F.col("arm") == name, F.col(column)))

    sided = scored.withColumn("sample_size", size).groupBy("test_id").agg(
        *[arm(c, a).alias(f"{a}_{c}") for a in ("control", "treatment") for c in ("recall", "false_positive_rate", "sample_size")]
    )
    return sided.withColumn("recall_difference", F.col("treatment_recall") - F.col("control_recall"))


def class_weights(df: DataFrame, label: str = "actual") -> DataFrame:
    """Balanced weight n / (2 * n_c) per class and the negative/positive ratio."""
    totals = df.agg(
        F.struct(
            F.count(label).alias("n"),
            count_where(F.col(label) == 1).alias("pos"),
            count_where(F.col(label) == 0).alias("neg"),
        )
    ).scalar()
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("_t", totals).select(
        label,
        "count",
        safe_divide("_t.n", 2 * F.col("count")).alias("weight"),
        safe_divide("_t.neg", "_t.pos").alias("scale_pos_weight"),
    )


def model_effectiveness(joined: DataFrame, by: str = "equipment_type") -> DataFrame:
    """Per segment: counts, recall %, false-discovery % and true false-positive %."""
    actual = count_where(F.col("actual") == 1)
    predicted = count_where(F.col("predicted") == 1)
    false_pos = _outcome(0, 1)
    return joined.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        actual.alias("actual_failures"),
        predicted.alias("predicted_failures"),
        _outcome(1, 1).alias("true_positives"),
        _outcome(1, 0).alias("false_negatives"),
        false_pos.alias("false_positives"),
        percent(_outcome(1, 1), actual).alias("recall_percent"),
        percent(false_pos, predicted).alias("fdr_percent"),
        percent(false_pos, count_where(F.col("actual") == 0)).alias("fpr_percent"),
    )


def economic_effect(df: DataFrame) -> DataFrame:
    """Daily outcome counts summed to one row with costs and savings."""
    daily = (
        df.filter(F.col("actual").isNotNull())
        .groupBy(F.to_date("prediction_timestamp").alias("day"))
        .agg(
            _outcome(0, 1).alias("false_positives"),
            _outcome(1, 0).alias("false_negatives"),
            _outcome(1, 1).alias("true_positives"),
        )
    )
    return daily.agg(
        F.sum("false_positives").alias("total_false_positives"),
        F.sum("false_negatives").alias("total_false_negatives"),
        F.sum("true_positives").alias("total_true_positives"),
        (F.sum("false_positives") * COST_FALSE_POSITIVE).alias("fp_cost"),
        (F.sum("false_negatives") * COST_FALSE_NEGATIVE).alias("fn_cost"),
        (F.sum("true_positives") * SAVING_TRUE_POSITIVE).alias("tp_savings"),
    )


def monitoring_alerts(changes: DataFrame) -> DataFrame:
    """Alert rows from metric changes (metric_name, metric_date, metric_value, previous_value, change)."""
    name, change, value = F.col("metric_name"), F.col("change"), F.col("metric_value")
    kind = (
        F.when((name == "recall") & (change <= -MONITOR_LIMITS["recall_drop"]), F.lit("recall_drop"))
        .when((name == "fpr") & (change >= MONITOR_LIMITS["fpr_increase"]), F.lit("fpr_increase"))
        .when((name == "psi") & (value > MONITOR_LIMITS["data_drift"]), F.lit("data_drift"))
        .when((name == "inference_time_ms") & (value > MONITOR_LIMITS["inference_time"]), F.lit("inference_time"))
    )
    return changes.withColumn("alert_type", kind).filter(F.col("alert_type").isNotNull())


def soft_vote(scores: Sequence[DataFrame], key: str, p_col: str = "p") -> DataFrame:
    """Mean of several models' probabilities per row key."""
    stacked = scores[0].select(key, p_col)
    for other in scores[1:]:
        stacked = stacked.unionByName(other.select(key, p_col))
    return stacked.groupBy(key).agg(F.avg(p_col).alias(p_col), F.count(p_col).alias("voters"))
