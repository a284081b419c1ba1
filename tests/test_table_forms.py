"""Tables as folders of several files give streams the same rows as single files; rows without a label are no class."""

import pytest

from assetlake.learning.splits import class_counts, undersample, with_balanced_weight
from assetlake.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    for name in ("events", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{base}/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("name", ["x01_x03_stream_validation", "x04_stream_enrichment", "x16_stream_restart", "s06_keyed_messages", "x05_stream_statistics"])
def test_stream_over_folder(spark, rows, folder, name):
    expected = rows(REGISTRY[name].run(spark, SF))
    assert expected
    assert rows(REGISTRY[name].run(spark, folder)) == expected


def test_null_labels_are_no_class(spark):
    data = [(i, 0 if i < 60 else 1 if i < 95 else None) for i in range(100)]
    df = spark.createDataFrame(data, "id int, label int")
    assert class_counts(df, "label") == {0: 60, 1: 35}
    assert class_counts(undersample(df, ["id"], "label"), "label") == {0: 35, 1: 35}
    weights = {r["label"]: r["weight"] for r in with_balanced_weight(df, "label").distinct().select("label", "weight").collect()}
    assert weights[0] == pytest.approx(95 / 120) and weights[1] == pytest.approx(95 / 70) and weights[None] is None
