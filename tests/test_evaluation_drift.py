import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetlake.operators import drift, profiling, reports
from assetlake.operators import evaluation as ev


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    n = 3000
    actual = (rng.random(n) < 0.2).astype(int)
    p = np.clip(np.round(0.3 * actual + rng.normal(0.4, 0.2, n), 2), 0, 1)  # many tied scores
    pdf = pd.DataFrame({"actual": actual, "p": p, "predicted": (p >= 0.5).astype(int)})
    return pdf, spark.createDataFrame(pdf).cache()


def test_metrics(scored):
    pdf, df = scored
    got = ev.classification_metrics(df).first()
    tp = int(((pdf.actual == 1) & (pdf.predicted == 1)).sum())
    fp = int(((pdf.actual == 0) & (pdf.predicted == 1)).sum())
    assert (got["true_positives"], got["false_positives"]) == (tp, fp)
    assert got["recall"] == pytest.approx(tp / pdf.actual.sum())
    assert got["precision"] == pytest.approx(tp / (tp + fp))


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0)], "actual int, predicted int")
    got = ev.classification_metrics(df).first()
    assert (got["recall"], got["precision"], got["f1_score"], got["false_positive_rate"], got["true_negative_rate"]) == (0, 0, 0, 0, 1)
    empty = ev.classification_metrics(df.filter("actual = 7")).first()
    assert empty["accuracy"] == 0


def test_auc_equals_rank_sum(scored):
    pdf, df = scored
    ranks = pdf.p.rank()
    pos, neg = pdf.actual.sum(), (1 - pdf.actual).sum()
    want = (ranks[pdf.actual == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    assert ev.roc_auc(df).first()["auc"] == pytest.approx(want)


def test_roc_points_are_monotone_and_end_at_one(scored):
    _, df = scored
    points = ev.roc_curve(df).orderBy(F.col("threshold").desc()).toPandas()
    assert points.fpr.is_monotonic_increasing and points.tpr.is_monotonic_increasing
    assert (points.fpr.iloc[-1], points.tpr.iloc[-1]) == (1.0, 1.0)


def test_sweep(scored):
    pdf, df = scored
    sweep = ev.threshold_sweep(df, 0.5, 0.5).orderBy("threshold").toPandas()
    assert len(sweep) == 81
    assert sweep.recall.is_monotonic_decreasing
    for _, r in sweep.iterrows():
        k = round(r.threshold * 100) / 100
        assert r.recall == pytest.approx(((pdf.p >= k) & (pdf.actual == 1)).sum() / pdf.actual.sum())
    best = ev.best_threshold(ev.threshold_sweep(df, 0.5, 0.5)).first()
    passing = sweep[sweep.business_pass]
    assert best["threshold"] == pytest.approx(passing.threshold[passing.custom_score.idxmax()])
    assert tuple(ev.best_threshold(ev.threshold_sweep(df, 1.0, 0.0)).first()) == (0.5, -1.0)


def test_best_f1(scored):
    pdf, df = scored
    best = ev.best_f1_threshold(df).first()
    f1 = {}
    for c in sorted(pdf.p.unique()):
        hit = pdf.p >= c
        tp = (hit & (pdf.actual == 1)).sum()
        pr, re = tp / hit.sum(), tp / pdf.actual.sum()
        f1[c] = 2 * pr * re / (pr + re + 1e-10)
    assert best["threshold"] == max(f1, key=lambda c: f1[c]) and best["found"]
    none = ev.best_f1_threshold(df, 1.1, 0.0).first()
    assert none["threshold"] == 0.5 and not none["found"]


def test_business_value(spark):
    metrics = spark.createDataFrame([(3, 2, 90, 1)], "true_positives int, false_positives int, true_negatives int, false_negatives int")
    got = ev.business_value(metrics).first()
    assert got["cost_with_system"] == 25000 and got["cost_without_system"] == pytest.approx(340000)
    assert got["total_savings"] == pytest.approx(345000) and got["roi_percentage"] == pytest.approx(1380)


def test_class_report_covers_classes_of_both_sides(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (1, 0)], "actual int, predicted int")
    got = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in ev.class_report(df).collect()}
    assert got == {0: (0.5, 0.5, 2), 1: (0.0, 0.0, 1), 2: (0.0, 0.0, 0)}


def test_choose_model(spark):
    rows = [("a", 0.9, 0.2, False, 0.72), ("b", 0.86, 0.1, True, 0.77), ("c", 0.88, 0.14, True, 0.75)]
    df = spark.createDataFrame(rows, "model_id string, recall double, false_positive_rate double, business_pass boolean, custom_score double")
    assert ev.choose_model(df).first()["model_id"] == "c"
    assert ev.choose_model(df.filter("NOT business_pass")).first()["model_id"] == "a"


def test_monitoring_alerts(spark):
    rows = [("recall", 0.8, -0.02), ("recall", 0.8, -0.01), ("fpr", 0.1, 0.04), ("psi", 0.26, 0.0), ("inference_time_ms", 60.0, 0.0)]
    df = spark.createDataFrame(rows, "metric_name string, metric_value double, change double")
    assert sorted(r["alert_type"] for r in ev.monitoring_alerts(df).collect()) == ["data_drift", "fpr_increase", "recall_drop"]


def test_stability_index(spark):
    a = spark.createDataFrame([(float(v),) for v in (-9, -1, -1, 0, 0, 1, 9)], "x double")
    b = spark.createDataFrame([(float(v),) for v in (-1, 0, 0, 0, 1)], "x double")
    assert drift.stability_index(a, a, "x").first()["psi"] == 0.0
    shares = [(2 / 7, 1 / 5), (2 / 7, 3 / 5), (1 / 7, 1 / 5)]
    want = sum((c - r) * math.log(c / r) for r, c in shares)
    assert drift.stability_index(a, b, "x").first()["psi"] == pytest.approx(want)
    assert drift.stability_index(a, b, "x", scale=100.0).first()["psi"] == pytest.approx(100 * want)
    with pytest.raises(ValueError):
        drift.stability_index(a, b, "unknown")


def _ks(spark, a, b):
    rows = [("k", float(v), False) for v in a] + [("k", float(v), True) for v in b]
    df = spark.createDataFrame(rows, "k string, v double, cur boolean")
    return drift.ks_test(df, ["k"], "v", F.col("cur")).first()


def test_ks(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 200), rng.normal(1, 1, 150)
    grid = np.sort(np.concatenate([a, b]))
    want = max(abs((a <= x).mean() - (b <= x).mean()) for x in grid)
    got, mirrored = _ks(spark, a, b), _ks(spark, b, a)
    assert got["ks_statistic"] == pytest.approx(want) == pytest.approx(mirrored["ks_statistic"])
    assert got["drift_detected"] and got["p_value"] < 1e-6
    same = _ks(spark, a, a)
    assert same["ks_statistic"] == 0 and same["p_value"] == 1.0 and not same["drift_detected"]
    few = _ks(spark, a[:30], b)
    assert (few["ks_statistic"], few["p_value"]) == (0.0, 1.0)


def test_mean_drift_of_a_negative_mean(spark):
    df = spark.createDataFrame([("k", -10.0, False), ("k", -5.0, True)], "k string, v double, cur boolean")
    assert drift.mean_drift(df, ["k"], "v", F.col("cur")).first()["mean_drift"] == pytest.approx(-0.5)
    assert drift.mean_drift(df, ["k"], "v", F.col("cur"), absolute=True).first()["mean_drift"] == pytest.approx(0.5)


def test_history_statistics(spark):
    df = spark.createDataFrame([(float(v),) for v in (10, 20, 30, 40, 50)], "v double")
    got = profiling.history_statistics(df, "v").first()
    assert (got["mean"], got["min"], got["max"], got["count"]) == (30.0, 10.0, 50.0, 5)
    assert got["std"] == pytest.approx(14.142, rel=1e-3)


def test_dataset_profile_counts_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b")], "x int, y string")
    assert tuple(profiling.dataset_profile(df).first()) == (4, 2, 1, 2, 1, 1)


def test_daily_report_compares_with_the_day_before(spark):
    cleaned = spark.createDataFrame(
        [("2024-01-01", True, 1), ("2024-01-03", True, 0), ("2024-01-03", False, 1)], "d string, is_valid boolean, target int"
    ).withColumn("created_at", F.col("d").cast("timestamp_ntz"))
    metrics = spark.createDataFrame([("2024-01-03", "recall", 0.875)], "d string, metric_name string, metric_value double").withColumn("metric_date", F.col("d").cast("date"))
    got = {r["metric_name"]: (r["metric_value"], r["metric_trend"]) for r in reports.daily_report(cleaned, metrics, "2024-01-03").collect()}
    assert got == {
        "Processed Records": ("2", "↑"),
        "Data Quality (%)": ("50.0", "→"),
        "Failure Count": ("1", "→"),
        "Model Recall (%)": ("87.5", "→"),
    }
