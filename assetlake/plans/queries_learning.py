"""Queries of the learning operators over the prediction and label tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetlake.learning import balancing, boosting, models, neighbors, splits
from assetlake.operators import evaluation as ev
from assetlake.plans.registry import query
from assetlake.session import cut_lineage

FEATURES = ["quantity", "discount", "tax", "price"]
KEYS = ["prediction_id"]


def labelled(t):
    """Every prediction row as a training row; the label follows two features and the recorded outcome as noise."""
    return t.training_rows


@query(
    "l01_stratified_split",
    """SELECT label, count(*) AS total, floor(0.8::DOUBLE * (count(*) - 1)) + 1 AS train
       FROM {training_rows} GROUP BY label""",
    floats="total train",
)
def l01(t):
    train, test = splits.stratified_split(labelled(t), KEYS, "label")
    both = train.select("label", F.lit(1).alias("side")).unionByName(test.select("label", F.lit(0).alias("side")))
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("total"), F.sum("side").alias("train"))


@query(
    "l02_stratified_folds",
    """WITH n AS (SELECT label, count(*) AS total FROM {training_rows} GROUP BY label),
            upto AS (SELECT label, f AS fold, CASE WHEN f = 4 THEN total
                            ELSE floor((f + 1) / 5::DOUBLE * (total - 1)) + 1 END AS upto
                     FROM n, generate_series(0, 4) g(f))
       SELECT label, CAST(fold AS INT) AS fold,
              upto - coalesce(lag(upto) OVER (PARTITION BY label ORDER BY fold), 0) AS rows FROM upto""",
    floats="rows",
)
def l02(t):
    folded = splits.with_fold(labelled(t), KEYS, "label", 5)
    return folded.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "l11_undersample",
    """SELECT label, (SELECT least(sum(label), sum(1 - label)) FROM {training_rows}) AS rows
       FROM {training_rows} GROUP BY label""",
    floats="rows",
)
def l11(t):
    return splits.undersample(labelled(t), KEYS, "label").groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "l09_nearest_neighbours",
    """WITH v AS (SELECT DISTINCT quantity AS a, discount AS b, tax AS c FROM {training_rows} WHERE label = 1)
       SELECT x.a, x.b, x.c, quantile_disc(d, 1) AS third FROM (
           SELECT p.a, p.b, p.c, sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2) AS d,
                  row_number() OVER (PARTITION BY p.a, p.b, p.c
                      ORDER BY (p.a - q.a) ** 2 + (p.b - q.b) ** 2 + (p.c - q.c) ** 2) AS rn
           FROM v p, v q) x WHERE rn <= 4 GROUP BY x.a, x.b, x.c""",
    floats="a b c third",
)
def l09n(t):
    minority = labelled(t).filter("label = 1")
    points = cut_lineage(neighbors.distinct_points(minority, ["quantity", "discount", "tax"]))
    found = neighbors.nearest(points, points, 3, 4)
    return found.groupBy("v").agg(F.max("distance").alias("third")).select(
        *[F.col("v")[i].alias(c) for i, c in enumerate("abc")], "third"
    )


@query(
    "l09_smote",
    """SELECT 1 AS label, sum(1 - 2 * label) AS rows, true AS inside FROM {training_rows}""",
    floats="rows",
)
def l09(t):
    rows = labelled(t)
    made = balancing.smote(rows, ["quantity", "discount", "tax"], "label")
    edges = rows.filter("label = 1").agg(
        F.struct(F.min("quantity").alias("a"), F.max("quantity").alias("b"))
    ).scalar()
    return (
        made.withColumn("e", edges)
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.bool_and(F.col("quantity").between(F.col("e.a"), F.col("e.b"))).alias("inside"),
        )
    )


@query("l10_adasyn")
def l10(t):
    return balancing.adasyn(labelled(t), ["quantity", "discount", "tax"], "label")


def _metrics(name, model, test):
    scored = models.score(model, test).select(F.col("label").alias("actual"), "p").withColumn(
        "predicted", F.when(F.col("p") >= 0.5, 1).otherwise(0)
    )
    return ev.classification_metrics(scored).select(F.lit(name).alias("model"), "recall", "false_positive_rate", "accuracy")


def _narrow(t):
    return labelled(t).select(*KEYS, *FEATURES, "label")


def _split(t):
    return splits.stratified_split(models.stored_for_training(_narrow(t), KEYS), KEYS, "label")


@query("l03_logistic_regression")
def l03(t):
    train, test = _split(t)
    return _metrics("logistic_regression", models.fit(train, models.logistic_regression(FEATURES)), test)


@query("l04_random_forest")
def l04(t):
    train, test = _split(t)
    return _metrics("random_forest", models.fit(train, models.random_forest(FEATURES, trees=20, depth=6)), test)


@query("l05_boosted_trees")
def l05(t):
    train, test = _split(t)
    return _metrics("boosted_trees", models.fit(train, models.boosted_trees(FEATURES, rounds=10, depth=4)), test)


@query("l06_linear_svc")
def l06(t):
    train, test = _split(t)
    return _metrics("linear_svc", models.fit(train, models.linear_svc(FEATURES)), test)


def _floors(name, model, test):
    """Whether a model finds three quarters of the held-out failures, at a balanced accuracy of three quarters."""
    reached = _metrics(name, model, test)
    balanced = (F.col("recall") + 1 - F.col("false_positive_rate")) / 2
    return reached.select("model", (F.col("recall") >= 0.75).alias("recall_reached"), (balanced >= 0.75).alias("balance_reached"))


def _floors_sql(name):
    return f"SELECT '{name}' AS model, count(*) > 0 AS recall_reached, count(*) > 0 AS balance_reached FROM {{training_rows}}"


@query("l05_second_order_boosting", _floors_sql("second_order_boosting"))
def l05s(t):
    train, test = _split(t)
    return _floors("second_order_boosting", boosting.fit(train, FEATURES, rounds=30), test)


@query("l06_radial_svc", _floors_sql("radial_svc"))
def l06r(t):
    train, test = _split(t)
    return _floors("radial_svc", models.fit(train, models.radial_svc(FEATURES)), test)


@query("l07_cross_validation")
def l07(t):
    return models.cross_validate(_narrow(t), {"logistic_regression": models.logistic_regression(FEATURES)}, KEYS, folds=3)


@query("l08_random_search")
def l08(t):
    space = {"maxIter": [3, 5], "maxDepth": [2, 3], "stepSize": [0.1, 0.2]}
    _, best, recall = models.random_search(_narrow(t), FEATURES, KEYS, space, draws=2, folds=2)
    row = (int(best["maxIter"]), int(best["maxDepth"]), float(best["stepSize"]), recall)
    return t.spark.createDataFrame([row], "max_iter int, max_depth int, step_size double, recall double")


@query("l13_isotonic_calibration")
def l13(t):
    train, test = _split(t)
    calibrated = models.calibrate(train, models.logistic_regression(FEATURES), KEYS, folds=3)
    scored = calibrated.score(test).select(F.col("label").alias("actual"), "p")
    return ev.calibration_curve(scored)


@query("l14_t06_feature_importance")
def l14(t):
    train, _ = _split(t)
    return models.feature_importance(t.spark, models.fit(train, models.logistic_regression(FEATURES)), FEATURES)


@query("l15_permutation_importance")
def l15(t):
    train, test = _split(t)
    model = models.fit(train, models.logistic_regression(FEATURES))
    return models.permutation_importance(model, test, FEATURES, KEYS)


@query("l16_l17_batch_scoring_log")
def l16(t):
    train, test = _split(t)
    model = models.fit(train, models.logistic_regression(FEATURES))
    scored = models.score_batch(model, test, 0.5)
    now = F.lit("2001-06-01 12:00:00").cast("timestamp_ntz")
    return models.prediction_log(scored, "lr-1", 0.5, now, 1.0, "batch-1", entity="prediction_id")
