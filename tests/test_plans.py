"""Plan checks: what is scanned, how it is exchanged, and that batch queries stay in the JVM."""

import re

import pytest

from assetlake.plans.catalog import REGISTRY
from assetlake.plans.views import Tables

SF = "/root/testdata/sf0.001"
BATCH = [
    "a01_layer_statistics", "a10_model_effectiveness", "a15_describe", "a27_ks_test", "a31_roc_auc", "a33_threshold_sweep",
    "j07_equipment_health", "j11_serve_with_fallback", "m12_long_to_wide", "p06_sensor_message_validation",
    "t02_j08_w08_top_risky_equipment", "u03_first_per_key", "w01_moving_average", "x05_sliding_statistics",
]


def plan(spark, name):
    return REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(spark, name)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["w01_moving_average", "w02_w03_rolling_features", "w07_row_number", "a31_roc_curve"])
def test_windows_over_rows_are_split_by_range(spark, name):
    """Windows over raw rows partition by the range as well; only the small per-cell totals are brought together."""
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan(spark, name))
    assert windows
    assert any("_range" in partition for partition, _ in windows)
    for partition, order in windows:
        assert "_range" in partition or "_range" in order


def test_scan_reads_only_what_is_needed(spark):
    text = plan(spark, "a10_model_effectiveness")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lineitem = next(s for s in schemas if "l_partkey" in s)
    assert "l_quantity" not in lineitem and "l_linestatus" not in lineitem
    assert "l_tax" not in plan(spark, "a07_economic_effect")


def test_time_filter_reaches_the_scan(spark):
    from pyspark.sql import functions as F

    from assetlake.operators import store

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # print the filters in full
    t = Tables(spark, SF)
    values = t.events.select(F.col("user_id").cast("string").alias("equipment_id"), F.col("event_type").alias("feature_name"), F.col("ts").alias("timestamp"))
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10", "2024-01-11"))
    text = store.scan_features(values, start, end, features=["click"])._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThanOrEqual(ts" in pushed and "event_type" in pushed


def test_top_k_is_taken_before_ranking(spark):
    assert "TakeOrderedAndProject" in plan(spark, "t01_w06_top_risky_recent")
