import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from assetlake.learning import balancing, boosting, hinge, models, neighbors, splits
from assetlake.session import cut_lineage
from assetlake.streaming import scoring

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 1200
    label = (rng.random(n) < 0.15).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "label": label, "a": rng.normal(3 * label, 1), "b": rng.normal(0, 1, n)})
    return pdf, spark.createDataFrame(pdf).repartition(4).cache()


def test_split_is_stratified_disjoint_and_repeatable(data):
    pdf, df = data
    train, test = splits.stratified_split(df, ["id"], "label")
    a, b = train.toPandas(), test.toPandas()
    assert set(a.id) | set(b.id) == set(pdf.id) and not set(a.id) & set(b.id)
    for value in (0, 1):
        n = (pdf.label == value).sum()
        assert (a.label == value).sum() == int(0.8 * (n - 1)) + 1
    again = splits.stratified_split(df.repartition(9), ["id"], "label")[0].toPandas()
    assert set(again.id) == set(a.id)


def test_folds_are_even(data):
    pdf, df = data
    counts = splits.with_fold(df, ["id"], "label", 5).toPandas().groupby(["label", "fold"]).size()
    assert len(counts) == 10 and counts.sum() == len(pdf)
    for value in (0, 1):
        assert counts[value].max() - counts[value].min() <= 1


def test_undersampling(data):
    pdf, df = data
    counts = splits.undersample(df, ["id"], "label").toPandas().label.value_counts()
    assert counts[0] == counts[1] == pdf.label.sum()


def test_weights(data):
    pdf, df = data
    weights = splits.with_balanced_weight(df, "label").groupBy("label").agg(F.sum("weight").alias("w")).toPandas()
    assert np.allclose(weights.w, len(pdf) / 2)


@pytest.mark.parametrize("cell_points", [2000, 40])
def test_neighbours_equal_brute_force(spark, monkeypatch, cell_points):
    monkeypatch.setattr(neighbors, "CELL_POINTS", cell_points)
    monkeypatch.setattr(neighbors, "CHUNK_QUERIES", 25)
    rng = np.random.default_rng(2)
    raw = np.concatenate([np.round(rng.normal(0, 1, (300, 3)), 2), rng.normal(8, 3, (100, 3)), np.zeros((200, 3))])
    df = spark.createDataFrame(pd.DataFrame(raw, columns=list("xyz")))
    points = cut_lineage(neighbors.distinct_points(df, list("xyz")))
    got = neighbors.nearest(points, points, 3, 5).toPandas()
    v = np.unique(raw, axis=0)
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    d.sort(axis=1)
    by_point = {k: np.sort(g.to_numpy()) for k, g in got.groupby(got.v.map(tuple)).distance}
    assert len(by_point) == len(v)
    for i, point in enumerate(v):
        assert np.allclose(by_point[tuple(point)], d[i, :5])


def test_smote_balances_on_segments(data):
    pdf, df = data
    made = balancing.smote(df, COLUMNS, "label").toPandas()
    minority = pdf[pdf.label == 1][COLUMNS].to_numpy()
    assert len(made) == (pdf.label == 0).sum() - len(minority)
    for x in made[COLUMNS].to_numpy()[:25]:  # each lies between two minority rows
        ends = minority[:, None, :] - x, minority[None, :, :] - x
        cross = np.abs(ends[0][..., 0] * ends[1][..., 1] - ends[0][..., 1] * ends[1][..., 0])
        between = (ends[0] * ends[1]).sum(axis=2) <= 1e-9
        assert (cross[between] < 1e-6).any()


def test_smote_of_identical_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1)] * 4 + [(float(i), 0.0, 0) for i in range(10)], "a double, b double, label int")
    made = balancing.smote(df, COLUMNS, "label")
    assert made.count() == 6 and made.distinct().count() == 1


def test_adasyn_prefers_rows_among_the_majority(spark):
    safe = [(100.0 + i / 10, 0.0, 1) for i in range(8)]
    mixed = [(float(i), 0.0, 1) for i in range(0, 40, 10)]
    majority = [(i + 0.5, 0.0, 0) for i in range(40)]
    df = spark.createDataFrame(safe + mixed + majority, "a double, b double, label int")
    made = balancing.adasyn(df, COLUMNS, "label", k=3).toPandas()
    assert abs(len(made) - 28) <= 2 and (made.a < 90).all()


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "boosted_trees", "linear_svc"])
def test_learners_separate(data, name):
    _, df = data
    options = {"random_forest": {"trees": 10, "depth": 4}, "boosted_trees": {"rounds": 5, "depth": 3}}.get(name, {})
    train, test = splits.stratified_split(df, ["id"], "label")
    model = models.fit(train, getattr(models, name)(COLUMNS, **options))
    scored = models.score(model, test).toPandas()
    ranks = scored.p.rank()
    pos, neg = (scored.label == 1).sum(), (scored.label == 0).sum()
    assert (ranks[scored.label == 1].sum() - pos * (pos + 1) / 2) / (pos * neg) > 0.9
    assert scored.p.between(0, 1).all()


@pytest.fixture(scope="module")
def fitted(data):
    return models.fit(data[1], models.logistic_regression(COLUMNS))


def test_saved_model_scores_the_same(spark, data, fitted, tmp_path):
    models.save(fitted, str(tmp_path / "m"))
    again = models.load(str(tmp_path / "m"))
    a = models.score(fitted, data[1]).orderBy("id").toPandas().p
    assert np.allclose(a, models.score(again, data[1]).orderBy("id").toPandas().p)


def test_batch_scores_and_log(spark, data, fitted):
    scored = models.score_batch(fitted, data[1].withColumn("equipment_id", F.col("id").cast("string")), 0.5)
    row = scored.filter("predicted_failure = 0").first()
    assert row["confidence"] == pytest.approx(1 - row["failure_probability"])
    log = models.prediction_log(scored, "m1", 0.5, F.lit("2024-01-01").cast("timestamp_ntz"), 1.0, "b")
    assert log.count() == log.select("prediction_id").distinct().count() == data[1].count()


def test_importance_finds_the_signal(spark, data, fitted):
    assert models.feature_importance(spark, fitted, COLUMNS).first()["feature"] == "a"
    losses = models.permutation_importance(fitted, data[1], COLUMNS, ["id"]).toPandas().set_index("feature").auc_loss
    assert losses["a"] > 0.2 > abs(losses["b"])


def test_permutation_keeps_the_values(data):
    pdf, df = data
    numbered = models.numbered_twice(df, ["id"])
    got = models.shuffled_column(numbered, "a").toPandas().sort_values("id")
    assert np.allclose(np.sort(got.a), np.sort(pdf.a)) and not np.allclose(got.a, pdf.a)
    assert np.allclose(got.b, pdf.b)


def test_calibration_improves_the_fit(data):
    pdf, df = data
    calibrated = models.calibrate(df, models.logistic_regression(COLUMNS), ["id"], folds=3)
    scored = calibrated.score(df).toPandas()
    assert scored.p.mean() == pytest.approx(pdf.label.mean(), abs=0.03)


def test_cross_validation_and_search(data):
    _, df = data
    table = models.cross_validate(df, {"lr": models.logistic_regression(COLUMNS)}, ["id"], folds=3).first()
    assert table["recall_mean"] > 0.8 and table["auc_mean"] > 0.9 and table["recall_std"] < 0.2
    space = {"maxIter": [2], "maxDepth": [2, 3], "stepSize": [0.1]}
    assert models.sample_grid(space, 5) == models.sample_grid(space, 5)
    _, best, recall = models.random_search(df, COLUMNS, ["id"], space, draws=1, folds=2)
    assert best["maxIter"] == 2 and 0 <= recall <= 1


def folds_by_hand(df, folds):
    """Training and held-out rows of each fold, weighted as the validation has them."""
    ready = splits.with_fold(splits.with_balanced_weight(df, "label"), ["id"], "label", folds)
    return [(ready.filter(F.col("fold") != i), ready.filter(F.col("fold") == i)) for i in range(folds)]


def counted_fits(monkeypatch):
    fitted, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, rows, *a: fitted.append(sorted(rows.columns)) or fit(self, rows, *a))
    return fitted


def test_cross_validation_fits_once_a_fold(data, monkeypatch):
    _, df = data
    df = df.unionByName(df.limit(5).withColumn("label", F.lit(None).cast("int")))
    recalls, aucs = [], []
    for rest, held_out in folds_by_hand(df, 3):
        scored = models.logistic_regression(COLUMNS).fit(rest).transform(held_out)
        recalls.append(scored.filter("label = 1").agg(F.avg(F.col("prediction"))).first()[0])
        aucs.append(BinaryClassificationEvaluator().evaluate(scored))
    fitted = counted_fits(monkeypatch)
    got = models.cross_validate(df, {"lr": models.logistic_regression(COLUMNS)}, ["id"], folds=3).first()
    assert fitted == [sorted([*COLUMNS, "label", "weight", "fold"])] * 3  # no fit on all rows, no key in the rows kept
    want = [np.mean(recalls), np.std(recalls), np.mean(aucs), np.std(aucs)]
    assert np.allclose([got[c] for c in ("recall_mean", "recall_std", "auc_mean", "auc_std")], want, atol=1e-4)


def test_random_search_keeps_narrow_rows(data, monkeypatch):
    _, df = data
    fitted, kept = counted_fits(monkeypatch), df.sparkSession.sparkContext._jsc.getPersistentRDDs
    before = set(kept().keys())
    space = {"maxIter": [2], "maxDepth": [1, 3], "stepSize": [0.1]}
    model, best, recall = models.random_search(df, COLUMNS, ["id"], space, draws=2, folds=2)
    assert all(sorted([*COLUMNS, "label", "weight", "fold"]) == columns for columns in fitted)
    assert model.stages[-1].getMaxDepth() == best["maxDepth"] and 0 <= recall <= 1
    assert set(kept().keys()) <= before


def test_folds_without_failures_are_refused(data):
    _, df = data
    with pytest.raises(ValueError, match="class 1"):
        models.cross_validate(df.filter("label = 0"), {"lr": models.logistic_regression(COLUMNS)}, ["id"], folds=2)


def test_permutation_importance_joins_once(data, fitted, monkeypatch):
    _, df = data
    joins, curves = [], []
    shuffled, area = models.shuffled_columns, models.roc_auc
    monkeypatch.setattr(models, "shuffled_columns", lambda n, c: joins.append(list(c)) or shuffled(n, c))
    monkeypatch.setattr(models, "roc_auc", lambda *a: curves.append(1) or area(*a))
    got = {r["feature"]: r["auc_loss"] for r in models.permutation_importance(fitted, df, COLUMNS, ["id"]).collect()}
    assert joins == [COLUMNS] and len(curves) == 1
    numbered = models.numbered_twice(df.select("id", *COLUMNS, "label"), ["id"])

    def auc(frame):
        return area(models.score(fitted, frame).select(F.col("label").alias("actual"), "p")).first()["auc"]

    for c in COLUMNS:
        assert got[c] == pytest.approx(auc(numbered) - auc(models.shuffled_column(numbered, c)), abs=1e-12)


def test_cached_results(spark):
    stored = spark.createDataFrame([("e1", "2024-01-01 11:58:00", 0.9, 1), ("e2", "2024-01-01 11:00:00", 0.2, 0)], "equipment_id string, t string, failure_probability double, predicted_failure int")
    cached = scoring.last_results(stored.select("equipment_id", F.col("t").cast("timestamp_ntz").alias("event_time"), "failure_probability", "predicted_failure"))
    asked = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "equipment_id string")
    hits, misses = scoring.with_cached(asked, cached, F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    assert [r["equipment_id"] for r in hits.collect()] == ["e1"]
    assert sorted(r["equipment_id"] for r in misses.collect()) == ["e2", "e3"]


def plain_boosting(x, y, w, cuts, rounds, depth, rate=0.1, l2=1.0):
    """Second-order boosting row by row over nodes, without histograms, trees as nested tuples."""
    bins = np.stack([np.where(np.isnan(v), 0, np.searchsorted(c, v) + 1) for v, c in zip(x.T, cuts)], axis=1)
    margin = np.zeros(len(y))

    def grow(rows, g, h, level):
        value = -rate * g[rows].sum() / (h[rows].sum() + l2)
        best = (0.0, None, None)
        if level < depth:
            for f in range(x.shape[1]):
                for b in range(bins[:, f].max() + 1):
                    left = rows & (bins[:, f] <= b)
                    right = rows & (bins[:, f] > b)
                    if not left.any() or not right.any() or min(h[left].sum(), h[right].sum()) < 1.0:
                        continue
                    parts = [g[part].sum() ** 2 / (h[part].sum() + l2) for part in (left, right, rows)]
                    gain = round((parts[0] + parts[1] - parts[2]) / 2, 9)
                    if gain > best[0]:
                        best = (gain, left, right)
        if best[1] is None:
            margin[rows] += value
        else:
            grow(best[1], g, h, level + 1)
            grow(best[2], g, h, level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grow(np.ones(len(y), bool), w * (p - y), w * p * (1 - p), 0)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("store_every", [2, 10])
def test_second_order_boosting_equals_a_plain_version(spark, data, monkeypatch, store_every):
    monkeypatch.setattr(boosting, "STORE_EVERY", store_every)
    pdf = data[0].copy()
    pdf["a"] = pdf.a.mask(pdf.id % 17 == 0)
    pdf["b"] = pdf.b.round(1)
    df = spark.createDataFrame(pdf.astype({"a": object}).where(pdf.notna(), None), "id long, label int, a double, b double")
    weight = len(pdf) / (2 * pdf.label.map(pdf.label.value_counts()))
    model = boosting.fit(df, COLUMNS, rounds=5, depth=3, bins=16)
    want = plain_boosting(pdf[COLUMNS].to_numpy(float), pdf.label.to_numpy(), weight.to_numpy(), model.cuts, 5, 3)
    got = models.score(model, df).orderBy("id").toPandas().p
    assert np.abs(got - want).max() < 1e-9
    again = boosting.BoostedModel.from_json(model.to_json())
    assert (models.score(again, df).orderBy("id").toPandas().p == got).all()
    assert model.importance()["a"] > 0


@pytest.mark.parametrize("bins, width", [(16, 1), (300, 4)])
def test_second_order_boosting_keeps_rows_in_blocks(spark, data, monkeypatch, bins, width):
    pdf, df = data
    kept, weights = [], len(pdf) / (2 * pdf.label.map(pdf.label.value_counts())).to_numpy()
    keep = boosting.stored
    monkeypatch.setattr(boosting, "stored", lambda frame, name: kept.append(keep(frame, name)) or kept[-1])
    model = boosting.fit(df, COLUMNS, rounds=2, depth=2, bins=bins)
    want = plain_boosting(pdf[COLUMNS].to_numpy(float), pdf.label.to_numpy(), weights, model.cuts, 2, 2)
    assert np.abs(models.score(model, df).orderBy("id").toPandas().p - want).max() < 1e-9
    blocks = kept[0].toPandas()
    assert len(blocks) <= 4 and blocks.bins.map(len).sum() == width * len(COLUMNS) * len(pdf)


def test_second_order_boosting_of_odd_tables(spark, data):
    df = data[1].limit(50)
    kind = "a double, b double, label int"
    empty = boosting.fit(spark.createDataFrame([], kind), COLUMNS, rounds=3)
    assert not empty.trees and set(models.score(empty, df).toPandas().p) == {0.5}
    rows = [(1.0, None, 1), (float("nan"), None, 1), (2.0, None, 1), (None, None, None)]
    single = boosting.fit(spark.createDataFrame(rows, kind), COLUMNS, rounds=3, depth=2)
    assert len(single.trees) == 3 and (models.score(single, df).toPandas().p > 0.5).all()


def ring(n, seed):
    draws = np.random.default_rng(seed)
    radius, angle = np.where(np.arange(n) % 2, 3, 1) + draws.normal(0, 0.2, n), draws.uniform(0, 2 * np.pi, n)
    return pd.DataFrame({"label": np.arange(n) % 2, "a": radius * np.cos(angle), "b": radius * np.sin(angle)})


def test_fourier_features_approximate_the_kernel(spark, tmp_path):
    size, gamma = 2000, 0.5
    rows = ring(40, 3)
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="scaled").transform(spark.createDataFrame(rows))
    made = models.FourierFeatures(width=2, size=size, gamma=gamma)
    z = np.stack(made.transform(vectors).toPandas().features.map(lambda v: v.toArray()))
    x = rows[COLUMNS].to_numpy()
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - kernel).max() < 5 * np.sqrt(1.5 / size)  # five deviations of one product
    made.save(str(tmp_path / "f"))
    again = models.FourierFeatures.load(str(tmp_path / "f")).transform(vectors).toPandas().features
    assert (z == np.stack(again.map(lambda v: v.toArray()))).all()


def test_radial_kernel_beats_the_linear_one_on_a_ring(spark):
    train, test = spark.createDataFrame(ring(600, 1)), spark.createDataFrame(ring(300, 2))
    right = {}
    for name in ("radial_svc", "linear_svc"):
        scored = models.score(models.fit(train, getattr(models, name)(COLUMNS)), test).toPandas()
        right[name] = ((scored.p >= 0.5) == scored.label).mean()
    assert right["radial_svc"] > 0.97 and right["linear_svc"] < 0.7


def test_radial_fit_keeps_no_features_and_reaches_the_loss_of_a_kept_fit(spark, monkeypatch, tmp_path):
    train = splits.with_balanced_weight(spark.createDataFrame(ring(600, 1)), "label")
    stages = models.radial_svc(COLUMNS, size=32).getStages()
    assembled, scaled = stages[0], stages[1]
    flat = assembled.transform(train)
    ready = scaled.fit(flat).transform(flat)
    features = stages[2].transform(ready)
    kept = LinearSVC(weightCol="weight", maxIter=100).fit(features)
    rows = features.toPandas()
    z, y, w = np.stack(rows.features.map(lambda v: v.toArray())), 2 * rows.label - 1, rows.weight

    def loss(coefficients, intercept):
        return (w * np.maximum(0, 1 - y * (z @ np.array(coefficients) + intercept))).sum() / w.sum()

    monkeypatch.setattr(models.FourierFeatures, "_transform", lambda self, df: df.withColumn("features", F.raise_error(F.lit("made")).cast("string")))
    monkeypatch.setattr(hinge, "AT_ONCE", 50)
    made = models.radial_svc(COLUMNS, size=32).fit(train)
    part = made.stages[3]
    fitted = part.getOrDefault("coefficients"), part.getOrDefault("intercept")
    assert loss(*fitted) <= 1.02 * loss(kept.coefficients.toArray(), kept.intercept) + 1e-3
    margin = np.stack(part.transform(ready).toPandas().margin.map(lambda v: v.toArray()))[:, 1]
    assert np.abs(margin - (z @ np.array(fitted[0]) + fitted[1])).max() < 1e-9
    part.save(str(tmp_path / "m"))
    again = np.stack(hinge.FourierMargin.load(str(tmp_path / "m")).transform(ready).toPandas().margin.map(lambda v: v.toArray()))[:, 1]
    assert (again == margin).all()


def test_radial_fit_refuses_other_labels(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 1.0, 1), (3.0, 3.0, 2)], "a double, b double, label int")
    with pytest.raises(Exception, match="label must be 0 or 1"):
        models.fit(rows, models.radial_svc(COLUMNS, size=8))


def test_radial_fit_takes_few_passes_and_margins_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (3000, 2))
    label = (np.sin(2 * x[:, 0]) + x[:, 1] ** 2 + rng.normal(0, 1, 3000) > 1).astype(int)
    train = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "label": label})).repartition(6)
    passes, made = [], hinge._hinge
    monkeypatch.setattr(hinge, "_hinge", lambda *given: passes.append(1) or made(*given))
    monkeypatch.setattr(hinge, "BLOCK_ROWS", 100)
    pipeline = models.radial_svc(COLUMNS, size=64)
    model = models.fit(train, pipeline)
    assert len(passes) <= 30
    weighted = splits.with_balanced_weight(train, "label")
    features = PipelineModel(model.stages[:3]).transform(weighted)
    rows = features.toPandas()
    z, y, w = np.stack(rows.features.map(lambda v: v.toArray())), 2 * rows.label - 1, rows.weight

    def loss(coefficients, intercept):
        return (w * np.maximum(0, 1 - y * (z @ np.array(coefficients) + intercept))).sum() / w.sum()

    part = model.stages[3]
    reached = loss(part.getOrDefault("coefficients"), part.getOrDefault("intercept"))
    kept = LinearSVC(weightCol="weight", maxIter=100).fit(features)
    assert reached <= loss(kept.coefficients.toArray(), kept.intercept)
    # a logistic fit that reads the margins row by row gives the same probabilities
    margins = PipelineModel(model.stages[:4]).transform(weighted).select("label", "weight", "margin")
    plain = LogisticRegression(weightCol="weight", featuresCol="margin").fit(margins)
    assert abs(model.stages[4].coefficients.toArray() - plain.coefficients.toArray()).max() < 1e-6
    # sums that are added up in the cluster first give the same fit
    monkeypatch.setattr(hinge, "ROWS_PER_TASK", 400)
    monkeypatch.setattr(hinge, "TASKS_A_SUM", 2)
    again = models.fit(train, pipeline).stages[3]
    assert np.allclose(again.getOrDefault("coefficients"), part.getOrDefault("coefficients"), rtol=1e-2, atol=1e-2)


def test_a_radial_pass_gives_loss_gradient_and_second_derivatives():
    rng = np.random.default_rng(3)
    x, signed = rng.normal(0, 1, (500, 2)).astype("<f4"), rng.uniform(0.5, 2, 500) * rng.choice([-1, 1], 500)
    weights, shifts = hinge.draws(2, 6, 0.5, 1)
    z = np.column_stack([np.cos(x @ weights.T + shifts) * 2**0.5, np.ones(500)])
    at, step, width, length = rng.normal(0, 0.3, 7), rng.normal(0, 0.3, 7), 0.5, 0.25

    def loss(point):
        u = 1 - np.sign(signed) * (z @ point)
        return np.where(u < -width, 0, np.where(u > width, u, (u + width) ** 2 / (4 * width))) @ np.abs(signed)

    batch = pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, signed)], ["x", "signed"])
    out, = hinge._hinge(weights, shifts, at, step, length, width)(iter([batch]))
    sums = np.frombuffer(out.column(0)[0].as_buffer())
    k = len(hinge.LENGTHS) + 1
    assert np.allclose(sums[:k], [loss(at + t * step) for t in (0, *hinge.LENGTHS)], rtol=1e-4)
    there, tiny = at + length * step, 1e-4 * np.eye(7)
    slope = [(loss(there + d) - loss(there - d)) / 2e-4 for d in tiny]
    assert np.allclose(sums[k : k + 7], slope, rtol=1e-2, atol=0.1)
    bent = np.abs(1 - np.sign(signed) * (z @ there)) < width
    bend = (z[bent] * (np.abs(signed[bent]) / (2 * width))[:, None]).T @ z[bent]
    assert np.allclose(sums[k + 7 :], bend[np.triu_indices(7)], rtol=1e-3, atol=0.1)


def test_margins_of_many_turns(spark):
    part = hinge.FourierMargin()._set(width=1, size=3, gamma=0.5, seed=1, inputCol="v", outputCol="m", coefficients=[1.0, -2.0, 0.5], intercept=0.25)
    values = [-40.0, 0.0, 0.1, 700.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    vectors = rows.withColumn("v", array_to_vector(F.array("x")))
    got = [r["m"][1] for r in part.transform(vectors).orderBy("i").collect()]
    weights, shifts = hinge.draws(1, 3, 0.5, 1)
    for v, m in zip(values, got):
        assert abs((2 / 3) ** 0.5 * np.cos(weights[:, 0] * v + shifts) @ [1.0, -2.0, 0.5] + 0.25 - m) < 1e-10


def test_boosted_trees_on_blocks_equal_those_of_mllib(spark, tmp_path):
    rng = np.random.default_rng(8)  # beyond 10,000 rows MLlib draws rows for its cuts
    x = np.column_stack([rng.normal(0, 1, 12000), rng.integers(0, 6, 12000), np.zeros(12000)])
    label = (x[:, 0] + 0.4 * x[:, 1] + rng.normal(0, 1, 12000) > 1.5).astype(int)
    train = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": label})).repartition(5)
    fits = {}
    for name, kind in (("blocks", models.BlockGBT), ("rows", GBTClassifier)):
        pipeline = models.boosted_trees([*COLUMNS, "c"], rounds=8, depth=3)
        learner = pipeline.getStages()[-1]
        assert isinstance(learner, models.BlockGBT)
        if kind is GBTClassifier:
            plain = GBTClassifier(labelCol="label", weightCol="weight", maxIter=8, maxDepth=3, stepSize=0.1, seed=models.SEED)
            pipeline = Pipeline(stages=[pipeline.getStages()[0], plain])
        fits[name] = models.fit(train, pipeline)
    a, b = (fits[n].stages[-1] for n in ("blocks", "rows"))
    assert a.treeWeights == b.treeWeights and a.numFeatures == b.numFeatures and a.getNumTrees == b.getNumTrees
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=1e-9)
    p = [models.score(fits[n], train).select("a", "p").toPandas().sort_values("a").p.to_numpy() for n in ("blocks", "rows")]
    assert np.abs(p[0] - p[1]).max() < 1e-9
    models.save(fits["blocks"], str(tmp_path / "gbt"))
    again = models.score(models.load(str(tmp_path / "gbt")), train).select("a", "p").toPandas().sort_values("a").p.to_numpy()
    assert (again == p[0]).all()


def test_boosted_trees_refuse_other_labels(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0), (2.0, 1.0, 1), (3.0, 3.0, 2)], "a double, b double, label int")
    with pytest.raises(Exception, match="label must be 0 or 1"):
        models.fit(rows, models.boosted_trees(COLUMNS, rounds=2, depth=2))
