import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetlake.operators import features as feat
from assetlake.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 readings; one machine holds a third of them and one value repeats often."""
    rng = np.random.default_rng(7)
    n = 20000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(rng.random(n) < 0.34, "hot", "k" + pd.Series(rng.integers(0, 40, n)).astype(str)),
            "t": rng.integers(0, 5000, n),
            "v": np.where(rng.random(n) < 0.3, 5.0, np.round(rng.normal(10, 4, n), 3)),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


def test_quantiles_per_key(skewed):
    pdf, df = skewed
    got = ordering.exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0], ["k"]).toPandas()
    want = pdf.groupby("k").v.quantile([0.0, 0.1, 0.5, 0.9, 1.0])
    assert len(got) == len(want)
    for r in got.itertuples():
        assert r.value == pytest.approx(want[r.k, r.prob], abs=1e-9)


@pytest.mark.parametrize("buckets", [2, 64, 4096])
def test_quantiles_of_the_whole(skewed, monkeypatch, buckets):
    pdf, df = skewed
    monkeypatch.setattr(ordering, "DIGIT_BUCKETS", buckets)  # few buckets: many passes
    got = ordering.exact_quantiles(df, ["v", "t"], [0.25, 0.5, 0.75]).toPandas()
    assert len(got) == 6
    for r in got.itertuples():
        assert r.value == pytest.approx(pdf[r.column].quantile(r.prob), abs=1e-9)


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [1.0, None, 4.0]])
def test_quantiles_of_tiny_inputs(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.exact_quantiles(df, ["v"], [0.25]).collect()
    known = [v for v in values if v is not None]
    if known:
        assert got[0]["value"] == pytest.approx(np.quantile(known, 0.25))
    else:
        assert not got


def test_quantiles_of_extreme_doubles(spark):
    """Signs, zeros, denormals, neighbours that differ in the last bit, huge values and infinities."""
    values = [-np.inf, -1e308, -3.5, -1e-320, -0.0, 0.0, 5e-324, 1e-320, 1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 3) + 2**-51, 1.5, 2.0, 1e300, 1.7e308]
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values * 3)], "v double, k int")
    probs = [i / (len(values) * 3 - 1) for i in range(len(values) * 3)]
    got = {r["prob"]: r["value"] for r in ordering.exact_quantiles(df, ["v"], probs).collect()}
    ordered = sorted(values * 3)
    for i, p in enumerate(probs):
        low, high = ordered[int(np.floor(p * (len(ordered) - 1)))], ordered[int(np.ceil(p * (len(ordered) - 1)))]
        assert low <= got[p] <= high
    assert got[0.0] == -np.inf and got[1.0] == 1.7e308
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert [r["value"] for r in ordering.exact_quantiles(nan, ["v"], [0.0, 0.5]).orderBy("prob").collect()] == [1.0, 2.0]


def test_quantiles_shuffle_histograms_only(spark):
    """A pass shuffles one row for each bucket a task has seen, not the rows."""
    df = spark.range(0, 200_000, 1, 4).selectExpr("sqrt(cast(id AS double)) AS v")
    plan = ordering.exact_quantiles(df, ["v"], [0.5])
    assert plan.first()["value"] == pytest.approx(np.quantile(np.sqrt(np.arange(200_000.0)), 0.5), abs=1e-12)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in text and "raise_error" not in text


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    got = {r["k"]: r["value"] for r in ordering.exact_quantiles(df, ["v"], [0.5], ["k"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_row_numbers(skewed):
    pdf, df = skewed
    got = ordering.row_numbers(df, ["t", "id"], ["k"], ranges=16).toPandas().sort_values(["k", "t", "id"])
    assert (got.rn.to_numpy() == (got.groupby("k").cumcount() + 1).to_numpy()).all()
    whole = ordering.row_numbers(df, ["t", "id"]).toPandas().sort_values(["t", "id"])
    assert (whole.rn.to_numpy() == np.arange(1, len(pdf) + 1)).all()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed, descending):
    pdf, df = skewed
    sums = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    got = ordering.running_totals(sums, "v", ["n"], ["k"], descending, ranges=8).toPandas()
    got = got.sort_values(["k", "v"], ascending=[True, not descending])
    assert (got.cum_n == got.groupby("k").n.cumsum()).all()


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_moving_average_and_lags_cross_the_cuts(skewed, ranges, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(ordering, "range_count", lambda _: ranges)
    want = pdf.sort_values(["k", "t", "id"])
    got = feat.moving_average(df, ["k"], ["t", "id"], "v", 10).toPandas().sort_values(["k", "t", "id"])
    expected = want.groupby("k").v.rolling(10, min_periods=1).mean().to_numpy()
    assert np.allclose(got.moving_average, expected)
    lagged = feat.lag_features(df, ["k"], ["t", "id"], "v").toPandas().sort_values(["k", "t", "id"])
    for k in (1, 3, 7):
        assert np.allclose(lagged[f"target_lag_{k}"], want.groupby("k").v.shift(k), equal_nan=True)


def test_carried_rows_are_bounded_by_ranges(spark):
    """Many small keys and one hot one at 1,024 ranges: only keys that a border cuts are carried."""
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 4000 END AS k", "id % 977 AS t", "id", "id * 0.5 AS v")
    ranged = ordering._with_composite_range(df, ["k", "t", "id"], 1024)
    per_range = ranged.groupBy("_range").count().toPandas()
    assert len(per_range) > 900 and per_range["count"].max() < 100
    carried = ordering.carried_rows(ranged, ["k"], ["t", "id"], 9, ["t", "id", "v"])
    assert 0 < carried.count() <= 1024 * 9
    assert carried.groupBy("k", "_range").count().agg(F.max("count")).first()[0] <= 9


@pytest.mark.parametrize("ranges", [2, 64])
def test_null_keys_text_keys_and_repeated_order_values(spark, ranges, monkeypatch):
    monkeypatch.setattr(ordering, "range_count", lambda _: ranges)
    data = [(k, t, i, float(i * i % 17)) for i, (k, t) in enumerate((k, t) for k in (None, "a", "b") for t in [None] + [1] * 30 + list(range(30)))]
    df = spark.createDataFrame(data, "k string, t int, id int, v double")
    got = {(r["id"]): r["moving_average"] for r in feat.moving_average(df, ["k"], ["t", "id"], "v", 5).collect()}
    assert len(got) == len(data)
    for key in (None, "a", "b"):
        rows = sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(rows):
            assert got[r[2]] == pytest.approx(np.mean([x[3] for x in rows[max(0, i - 4) : i + 1]]))


def test_no_row_is_lost_or_doubled(skewed):
    pdf, df = skewed
    out = feat.rolling_features(df, ["k"], ["t", "id"], ["v"], 3)
    assert out.count() == len(pdf)
    assert out.select("id").distinct().count() == len(pdf)


def test_whole_table_sequence(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(30)], "t int, v double")
    got = feat.moving_average(df, [], ["t"], "v", 3, full_only=True).orderBy("t").collect()
    assert [r["moving_average"] for r in got[:4]] == [None, None, 1.0, 2.0]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, t int, v double")
    assert feat.moving_average(df, ["k"], ["t"], "v").count() == 0
    assert ordering.row_numbers(df, ["t"], ["k"]).count() == 0
