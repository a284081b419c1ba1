"""Queries of the classifier-evaluation and drift operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.operators import drift
from assetlake.operators import evaluation as ev
from assetlake.operators.features import change_from_previous
from assetlake.plans.registry import query
from assetlake.session import cut_lineage

_COUNTS = """
    count(CASE WHEN actual = 1 AND predicted = 1 THEN 1 END) AS true_positives,
    count(CASE WHEN actual = 0 AND predicted = 1 THEN 1 END) AS false_positives,
    count(CASE WHEN actual = 0 AND predicted = 0 THEN 1 END) AS true_negatives,
    count(CASE WHEN actual = 1 AND predicted = 0 THEN 1 END) AS false_negatives"""
_RATES = """
    coalesce((true_positives + true_negatives) * 1.0
             / nullif(true_positives + true_negatives + false_positives + false_negatives, 0), 0) AS accuracy,
    coalesce(true_positives * 1.0 / nullif(true_positives + false_positives, 0), 0) AS precision,
    coalesce(true_positives * 1.0 / nullif(true_positives + false_negatives, 0), 0) AS recall,
    coalesce(2.0 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1_score,
    coalesce(false_positives * 1.0 / nullif(false_positives + true_negatives, 0), 0) AS false_positive_rate,
    coalesce(true_negatives * 1.0 / nullif(false_positives + true_negatives, 0), 0) AS true_negative_rate"""
_RATE_NAMES = "accuracy precision recall f1_score false_positive_rate true_negative_rate"


def _metrics_sql(by=""):
    group = f"GROUP BY {by}" if by else ""
    prefix = f"{by}, " if by else ""
    return f"SELECT *, {_RATES} FROM (SELECT {prefix}{_COUNTS} FROM {{predictions}} {group}) c"


@query("a29_classification_metrics", _metrics_sql(), floats=_RATE_NAMES, scale=9)
def a29(t):
    return ev.classification_metrics(t.predictions)


@query("a37_segment_metrics", _metrics_sql("discount"), floats="discount " + _RATE_NAMES, scale=9)
def a37(t):
    return ev.classification_metrics(t.predictions, ["discount"])


@query(
    "a40_target_check",
    f"""SELECT *, recall >= 0.85 AS recall_pass, false_positive_rate < 0.15 AS fpr_pass,
               recall >= 0.85 AND false_positive_rate < 0.15 AS business_pass FROM ({_metrics_sql("model_id")}) m""",
    floats=_RATE_NAMES,
    scale=9,
)
def a40(t):
    return ev.meets_targets(ev.classification_metrics(t.predictions, ["model_id"]))


@query(
    "a30_class_report",
    """WITH pairs AS (SELECT quality AS actual, toxic AS predicted FROM {labels}),
            s AS (SELECT actual AS class, count(*) AS support FROM pairs GROUP BY 1),
            c AS (SELECT predicted AS class, count(*) AS claimed FROM pairs GROUP BY 1),
            h AS (SELECT actual AS class, count(*) AS hit FROM pairs WHERE actual = predicted GROUP BY 1)
       SELECT coalesce(s.class, c.class) AS class, coalesce(hit * 1.0 / claimed, 0) AS precision,
              coalesce(hit * 1.0 / support, 0) AS recall,
              coalesce(2.0 * hit / (coalesce(support, 0) + coalesce(claimed, 0)), 0) AS f1_score,
              coalesce(support, 0) AS support
       FROM s FULL OUTER JOIN c ON s.class = c.class LEFT JOIN h ON coalesce(s.class, c.class) = h.class""",
    floats="precision recall f1_score",
    scale=9,
)
def a30(t):
    return ev.class_report(t.labels.select(F.col("quality").alias("actual"), F.col("toxic").alias("predicted")))


_SCORES = """
    s AS (SELECT p, sum(actual) AS pos, sum(1 - actual) AS neg FROM {predictions} GROUP BY p),
    c AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) AS cum_pos, sum(neg) OVER (ORDER BY p DESC) AS cum_neg,
                 sum(pos) OVER () AS total_pos, sum(neg) OVER () AS total_neg FROM s)"""


@query(
    "a31_roc_curve",
    f"""WITH {_SCORES} SELECT p AS threshold, CAST(cum_neg AS DOUBLE) / total_neg AS fpr,
               CAST(cum_pos AS DOUBLE) / total_pos AS tpr FROM c""",
    floats="threshold fpr tpr",
    scale=9,
)
def a31(t):
    return ev.roc_curve(t.predictions)


# probability that a positive outranks a negative, computed from ranks: independent of the trapezoid form
@query(
    "a31_roc_auc",
    """SELECT (sum(CASE WHEN actual = 1 THEN mid END) - count(CASE WHEN actual = 1 THEN 1 END)
               * (count(CASE WHEN actual = 1 THEN 1 END) + 1) / 2.0)
              / (count(CASE WHEN actual = 1 THEN 1 END) * 1.0 * count(CASE WHEN actual = 0 THEN 1 END)) AS auc
       FROM (SELECT actual, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS mid
             FROM {predictions}) r""",
    floats="auc",
    scale=9,
)
def a31b(t):
    return ev.roc_auc(t.predictions)


@query(
    "a31_roc_auc_by_model",
    """SELECT model_id, (sum(CASE WHEN actual = 1 THEN mid END) - count(CASE WHEN actual = 1 THEN 1 END)
               * (count(CASE WHEN actual = 1 THEN 1 END) + 1) / 2.0)
              / (count(CASE WHEN actual = 1 THEN 1 END) * 1.0 * count(CASE WHEN actual = 0 THEN 1 END)) AS auc
       FROM (SELECT model_id, actual, rank() OVER (PARTITION BY model_id ORDER BY p)
                    + (count(*) OVER (PARTITION BY model_id, p) - 1) / 2.0 AS mid FROM {predictions}) r
       GROUP BY model_id""",
    floats="auc",
    scale=9,
)
def a31c(t):
    return ev.roc_auc(t.predictions, ["model_id"])


_PR = f"""{_SCORES},
    pr AS (SELECT p, pos, total_pos, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
                  CAST(cum_pos AS DOUBLE) / total_pos AS recall, CAST(cum_neg AS DOUBLE) / total_neg AS fpr FROM c),
    f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pr)"""


@query(
    "a32_precision_recall_curve",
    f"WITH {_PR} SELECT p AS threshold, precision, recall, fpr, f1 FROM f",
    floats="threshold precision recall fpr f1",
    scale=9,
)
def a32(t):
    return ev.precision_recall_curve(t.predictions)


@query(
    "a32_average_precision",
    f"WITH {_PR} SELECT sum(CAST(pos AS DOUBLE) / total_pos * precision) AS average_precision FROM f",
    floats="average_precision",
    scale=9,
)
def a32b(t):
    return ev.average_precision(t.predictions)


def _sweep_sql(min_recall, max_fpr):
    return f"""SELECT *, recall >= {min_recall} AND fpr <= {max_fpr} AS business_pass,
        CASE WHEN recall >= {min_recall} AND fpr <= {max_fpr} THEN recall * (1 - fpr) ELSE -1 END AS custom_score
        FROM (SELECT k / 100.0::DOUBLE AS threshold,
                     count(CASE WHEN actual = 1 AND p >= k / 100.0::DOUBLE THEN 1 END) * 1.0::DOUBLE
                        / count(CASE WHEN actual = 1 THEN 1 END) AS recall,
                     count(CASE WHEN actual = 0 AND p >= k / 100.0::DOUBLE THEN 1 END) * 1.0::DOUBLE
                        / count(CASE WHEN actual = 0 THEN 1 END) AS fpr
              FROM {{predictions}}, range(10, 91) g(k) GROUP BY k) x"""


@query("a33_threshold_sweep", _sweep_sql(0.85, 0.15), floats="threshold recall fpr custom_score", scale=9)
def a33(t):
    return ev.threshold_sweep(t.predictions)


@query(
    "a33_best_threshold",
    f"""SELECT coalesce((SELECT threshold FROM ({_sweep_sql(0.5, 0.5)}) s WHERE business_pass
                         ORDER BY custom_score DESC, threshold LIMIT 1), 0.5) AS threshold,
               coalesce((SELECT max(custom_score) FROM ({_sweep_sql(0.5, 0.5)}) s WHERE business_pass), -1) AS custom_score""",
    floats="threshold custom_score",
    scale=9,
)
def a33b(t):
    return ev.best_threshold(ev.threshold_sweep(t.predictions, 0.5, 0.5))


@query(
    "a33_no_threshold_found",
    f"""SELECT coalesce((SELECT threshold FROM ({_sweep_sql(0.99, 0.01)}) s WHERE business_pass
                         ORDER BY custom_score DESC, threshold LIMIT 1), 0.5) AS threshold,
               coalesce((SELECT max(custom_score) FROM ({_sweep_sql(0.99, 0.01)}) s WHERE business_pass), -1) AS custom_score""",
    floats="threshold custom_score",
    scale=9,
)
def a33c(t):
    return ev.best_threshold(ev.threshold_sweep(t.predictions, 0.99, 0.01))


@query(
    "a34_best_f1_threshold",
    f"""WITH {_PR} SELECT p AS threshold, recall, fpr, f1, true AS found FROM f WHERE recall >= 0.6 AND fpr <= 0.4
        ORDER BY f1 DESC, p LIMIT 1""",
    floats="threshold recall fpr f1",
    scale=9,
)
def a34(t):
    return ev.best_f1_threshold(t.predictions, 0.6, 0.4)


@query(
    "a35_calibration_curve",
    """SELECT CAST(least(floor(p * 10), 9) AS INT) AS bin, avg(p) AS mean_predicted, avg(actual) AS fraction_positive,
              count(*) AS count FROM {predictions} GROUP BY 1""",
    floats="mean_predicted fraction_positive",
    scale=8,
)
def a35(t):
    return ev.calibration_curve(t.predictions)


@query(
    "a36_business_value",
    f"""SELECT model_id, cost_with_system, 340000.0 AS cost_without_system, saved AS savings_from_prevention,
               340000.0 - cost_with_system + saved AS total_savings,
               CASE WHEN cost_with_system > 0 THEN (340000.0 - cost_with_system + saved) * 100 / cost_with_system ELSE 0 END
                   AS roi_percentage
        FROM (SELECT model_id, false_positives * 5000.0 + false_negatives * 15000.0 AS cost_with_system,
                     true_positives * 10000.0 AS saved FROM ({_metrics_sql("model_id")}) m) b""",
    floats="cost_with_system cost_without_system savings_from_prevention total_savings roi_percentage",
)
def a36(t):
    value = ev.business_value(ev.classification_metrics(t.predictions, ["model_id"]))
    return value.select(
        "model_id", "cost_with_system", "cost_without_system", "savings_from_prevention", "total_savings", "roi_percentage"
    )


@query(
    "a38_error_profile",
    """SELECT CASE WHEN predicted = actual THEN 'Correct' WHEN predicted = 1 THEN 'False Positive' ELSE 'False Negative' END
                  AS error_type, count(*) AS count, avg(quantity) AS avg_quantity, avg(tax) AS avg_tax
       FROM {predictions} GROUP BY 1""",
    floats="avg_quantity avg_tax",
)
def a38(t):
    return ev.error_profile(t.predictions, ["quantity", "tax"])


_GAP = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, avg(CASE WHEN actual = 1 AND predicted = 0 THEN {c} END) AS missed_mean,
        avg(CASE WHEN actual = 1 AND predicted = 1 THEN {c} END) AS caught_mean,
        avg(CASE WHEN actual = 1 AND predicted = 0 THEN {c} END) - avg(CASE WHEN actual = 1 AND predicted = 1 THEN {c} END)
            AS difference FROM {{predictions}}"""
    for c in ("quantity", "tax", "inference_time_ms")
)


@query("a38_missed_versus_caught", _GAP, floats="missed_mean caught_mean difference")
def a38b(t):
    return ev.missed_versus_caught(t.predictions, ["quantity", "tax", "inference_time_ms"])


_COMPARE = f"""SELECT *, recall >= 0.85 AND false_positive_rate < 0.15 AS business_pass,
    recall * (1 - false_positive_rate) AS custom_score FROM ({_metrics_sql("model_id")}) m"""


@query(
    "a39_model_comparison",
    f"SELECT model_id, recall, false_positive_rate, precision, f1_score, business_pass, custom_score FROM ({_COMPARE}) c",
    floats="recall false_positive_rate precision f1_score custom_score",
    scale=9,
)
def a39(t):
    return ev.compare_models(t.predictions).select(
        "model_id", "recall", "false_positive_rate", "precision", "f1_score", "business_pass", "custom_score"
    )


@query(
    "a39_chosen_model",
    f"""SELECT model_id, recall, false_positive_rate, custom_score, business_pass FROM ({_COMPARE}) c
        ORDER BY business_pass DESC, CASE WHEN business_pass THEN recall ELSE custom_score END DESC, model_id LIMIT 1""",
    floats="recall false_positive_rate custom_score",
    scale=9,
)
def a39b(t):
    return ev.choose_model(ev.compare_models(t.predictions))


@query(
    "a41_monitoring_alerts",
    """SELECT metric_date, metric_name, metric_value, change,
              CASE metric_name WHEN 'recall' THEN 'recall_drop' ELSE 'fpr_increase' END AS alert_type
       FROM (SELECT *, metric_value - lag(metric_value) OVER (PARTITION BY metric_name ORDER BY metric_date) AS change
             FROM {daily_metrics}) d
       WHERE (metric_name = 'recall' AND change <= -0.02) OR (metric_name = 'fpr' AND change >= 0.03)""",
    floats="metric_value change",
    dates="metric_date",
    scale=9,
)
def a41(t):
    changes = change_from_previous(cut_lineage(t.daily_metrics), ["metric_name"], ["metric_date"], "metric_value")
    return ev.monitoring_alerts(changes).drop("previous_value")


_ARMS = f"""
    SELECT test_id, arm, true_positives + false_positives + true_negatives + false_negatives AS sample_size, {_RATES}
    FROM (SELECT test_id, arm, {_COUNTS} FROM {{predictions}} p
          JOIN (SELECT test_id, 'control' AS arm, control_model_id AS model_id, start_date, end_date FROM {{ab_tests}}
                UNION ALL SELECT test_id, 'treatment', treatment_model_id, start_date, end_date FROM {{ab_tests}}) a
            ON p.model_id = a.model_id
          WHERE CAST(prediction_timestamp AS DATE) BETWEEN start_date AND end_date GROUP BY test_id, arm) c"""


@query(
    "a43_ab_comparison",
    f"""SELECT c.test_id, c.recall AS control_recall, c.false_positive_rate AS control_false_positive_rate,
               c.sample_size AS control_sample_size, t.recall AS treatment_recall,
               t.false_positive_rate AS treatment_false_positive_rate, t.sample_size AS treatment_sample_size,
               t.recall - c.recall AS recall_difference
        FROM ({_ARMS}) c JOIN ({_ARMS}) t ON c.test_id = t.test_id AND c.arm = 'control' AND t.arm = 'treatment'""",
    floats="control_recall control_false_positive_rate treatment_recall treatment_false_positive_rate recall_difference",
    scale=9,
)
def a43(t):
    return ev.ab_comparison(t.predictions, t.ab_tests)


@query(
    "a46_class_weights",
    """SELECT toxic, count(*) AS count, (SELECT count(*) FROM {labels}) / (2.0 * count(*)) AS weight,
              (SELECT sum(1 - toxic) * 1.0 / sum(toxic) FROM {labels}) AS scale_pos_weight
       FROM {labels} GROUP BY toxic""",
    floats="weight scale_pos_weight",
    scale=9,
)
def a46(t):
    return ev.class_weights(t.labels, "toxic")


@query(
    "l12_soft_vote",
    """SELECT prediction_id, (p + quantity / 50 + (1 - discount)) / 3 AS p, 3 AS voters FROM {predictions}""",
    floats="p",
    scale=9,
)
def l12(t):
    first = t.predictions.select("prediction_id", "p")
    second = t.predictions.select("prediction_id", (F.col("quantity") / 50).alias("p"))
    third = t.predictions.select("prediction_id", (1 - F.col("discount")).alias("p"))
    return ev.soft_vote([first, second, third], "prediction_id")


# --- drift -----------------------------------------------------------------------------------------------

_SPLIT_TIME = "2024-01-16 00:00:00"


def _current():
    return F.col("reading_time") >= F.lit(_SPLIT_TIME).cast("timestamp_ntz")


_BIN = """CASE WHEN value < 0 THEN 0 WHEN value >= 200 THEN 11 ELSE CAST(floor(value / 20) AS BIGINT) + 1 END"""
_HISTOGRAMS = f"""
    r AS (SELECT {_BIN} AS bin, count(*) * 1.0 / sum(count(*)) OVER () AS ref_share FROM {{readings}}
          WHERE reading_time < TIMESTAMP '{_SPLIT_TIME}' GROUP BY 1),
    c AS (SELECT {_BIN} AS bin, count(*) * 1.0 / sum(count(*)) OVER () AS cur_share FROM {{readings}}
          WHERE reading_time >= TIMESTAMP '{_SPLIT_TIME}' GROUP BY 1)"""


def _two_periods(t):
    return t.readings.filter(~_current()), t.readings.filter(_current())


@query(
    "j06_histogram_full_outer",
    f"""WITH {_HISTOGRAMS} SELECT coalesce(r.bin, c.bin) AS bin, ref_share, cur_share
        FROM r FULL OUTER JOIN c ON r.bin = c.bin""",
    floats="ref_share cur_share",
    scale=9,
)
def j06(t):
    reference, current = _two_periods(t)
    return drift.histogram_pair(reference, current, "value", 0, 200, 10)


@query(
    "a25_stability_index",
    f"""WITH {_HISTOGRAMS} SELECT 'share' AS unit, sum((cur_share - ref_share) * ln(cur_share / ref_share)) AS psi
            FROM r JOIN c ON r.bin = c.bin
        UNION ALL SELECT 'percent', sum((cur_share - ref_share) * 100 * ln(cur_share / ref_share)) FROM r JOIN c ON r.bin = c.bin""",
    floats="psi",
    scale=9,
)
def a25(t):
    reference, current = _two_periods(t)
    share = drift.stability_index(reference, current, "value", 0, 200, 10).select(F.lit("share").alias("unit"), "psi")
    percent = drift.stability_index(reference, current, "value", 0, 200, 10, scale=100.0)
    return share.unionByName(percent.select(F.lit("percent").alias("unit"), "psi"))


@query(
    "a26_mean_drift",
    f"""SELECT equipment_id, reference_mean, current_mean,
               abs(current_mean - reference_mean) / (reference_mean + 1e-10) AS mean_drift
        FROM (SELECT equipment_id, avg(CASE WHEN reading_time < TIMESTAMP '{_SPLIT_TIME}' THEN value END) AS reference_mean,
                     avg(CASE WHEN reading_time >= TIMESTAMP '{_SPLIT_TIME}' THEN value END) AS current_mean
              FROM {{readings}} GROUP BY equipment_id) m""",
    floats="reference_mean current_mean mean_drift",
    scale=9,
)
def a26(t):
    return drift.mean_drift(t.readings, ["equipment_id"], "value", _current())


@query(
    "a27_ks_test",
    f"""WITH v AS (SELECT sensor, value, sum(CASE WHEN reading_time < TIMESTAMP '{_SPLIT_TIME}' THEN 1 ELSE 0 END) AS a,
                          sum(CASE WHEN reading_time >= TIMESTAMP '{_SPLIT_TIME}' THEN 1 ELSE 0 END) AS b
                   FROM {{readings}} GROUP BY sensor, value),
             s AS (SELECT sensor, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY sensor) AS na,
                          sum(b) OVER (PARTITION BY sensor) AS nb FROM v WINDOW w AS (PARTITION BY sensor ORDER BY value))
        SELECT sensor, CAST(na AS BIGINT) AS n_reference, CAST(nb AS BIGINT) AS n_current,
               max(abs(ca * 1.0::DOUBLE / na - cb * 1.0::DOUBLE / nb)) AS ks_statistic
        FROM s GROUP BY sensor, na, nb""",
    floats="ks_statistic",
    scale=9,
)
def a27(t):
    tested = drift.ks_test(t.readings, ["sensor"], "value", _current())
    return tested.select("sensor", "n_reference", "n_current", "ks_statistic")


@query("a27_ks_decision")
def a27b(t):
    return drift.ks_test(t.readings, ["equipment_id"], "value", _current())


