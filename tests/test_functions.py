from datetime import date

import pytest
from pyspark.sql import functions as F

from assetlake.functions import numeric, text, tiers


def one(spark, value, kind, column):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "p, shown",
    [(None, "N/A"), (0.0009, "<0.1%"), (0.001, "0.1%"), (0.9991, ">99.9%"), (0.999, "99.9%"), (0.1234, "12.3%"), (0.1235, "12.4%"), (0.5, "50.0%")],
)
def test_format_probability(spark, p, shown):
    assert one(spark, p, "double", text.format_probability("x")) == shown


@pytest.mark.parametrize("code, label", [("L", "Low Quality"), ("M", "Medium Quality"), ("H", "High Quality"), ("Z", "Unknown"), (None, "Unknown")])
def test_format_equipment_type(spark, code, label):
    assert one(spark, code, "string", text.format_equipment_type("x")) == label


def test_sql_functions_match_columns(spark):
    text.register_sql_functions(spark)
    row = spark.sql("SELECT format_probability(0.1235D) p, format_probability(NULL) n, format_equipment_type('M') t").first()
    assert tuple(row) == ("12.4%", "N/A", "Medium Quality")


@pytest.mark.parametrize(
    "p, level, tier", [(0.39, "normal", tiers.RECOMMEND_NONE), (0.4, "warning", tiers.RECOMMEND_WATCH), (0.6, "warning", tiers.RECOMMEND_SERVICE), (0.8, "critical", tiers.RECOMMEND_REPAIR)]
)
def test_alert_tiers(spark, p, level, tier):
    assert one(spark, p, "double", tiers.alert_level("x")) == level
    assert one(spark, p, "double", tiers.recommendation("x")) == tier


@pytest.mark.parametrize("p, category, score", [(0.3, "LOW", 25), (0.31, "MEDIUM", 50), (0.5, "MEDIUM", 50), (0.51, "HIGH", 75), (0.7, "HIGH", 75), (0.71, "CRITICAL", 100)])
def test_risk(spark, p, category, score):
    assert one(spark, p, "double", tiers.risk_category("x")) == category
    assert one(spark, p, "double", tiers.risk_score("x", F.lit(1))) == score
    assert one(spark, p, "double", tiers.risk_score("x", F.lit(0))) == 0


def test_threshold_decisions(spark):
    assert one(spark, 0.5, "double", tiers.decide("x")) == 1
    assert one(spark, 0.5, "double", tiers.decide("x", strict=True)) == 0
    assert one(spark, 0.8, "double", tiers.confidence("x", tiers.decide("x", 0.9))) == pytest.approx(0.2)


@pytest.mark.parametrize("wear, sql, notebook", [(49, "low", "low"), (50, "medium", "medium"), (149, "medium", "medium"), (150, "medium", "high"), (151, "high", "high"), (None, "unknown", "unknown")])
def test_wear_boundary(spark, wear, sql, notebook):
    assert one(spark, wear, "int", tiers.wear_category("x")) == sql
    assert one(spark, wear, "int", tiers.wear_category("x", upper_inclusive=False)) == notebook


def test_error_type_needs_both_classes(spark):
    assert one(spark, None, "int", tiers.error_type(F.lit(1), "x")) is None
    assert one(spark, 0, "int", tiers.error_type(F.lit(1), "x")) == "False Positive"


@pytest.mark.parametrize("value, bucket", [(-5.01, 0), (-5.0, 1), (4.99, 10), (5.0, 11)])
def test_width_bucket_edges(spark, value, bucket):
    assert one(spark, value, "double", numeric.equal_width_bucket("x", -5, 5, 10)) == bucket


def test_rounding_modes(spark):
    assert one(spark, 2.5, "double", numeric.round_half_up("x", 0)) == 3.0
    assert one(spark, 2.5, "double", numeric.round_half_even("x", 0)) == 2.0


def test_guards(spark):
    assert one(spark, 0.0, "double", numeric.safe_divide(F.lit(1.0), "x")) is None
    assert one(spark, 0.0, "double", numeric.safe_divide(F.lit(1.0), "x", 0.0)) == 0.0
    assert one(spark, "abc", "string", numeric.to_double("x")) == 0.0
    assert one(spark, "1.5", "string", numeric.to_double("x")) == 1.5


def test_time_text_and_dates(spark):
    assert one(spark, "nonsense", "string", text.parse_iso("x")) is None
    assert one(spark, "2024-01-15T10:30:00Z", "string", text.parse_iso("x")).hour == 10
    assert one(spark, "2024-03-01", "string", text.date_range_array(F.col("x").cast("date"), 30)) == [date(2024, 1, 31), date(2024, 3, 1)]


def test_json_and_keys(spark):
    assert one(spark, None, "int", text.json_object(F.col("x").alias("a"), F.lit(1).alias("b"))) == '{"a":null,"b":1}'
    assert one(spark, '{"recall": "0.8"}', "string", text.json_text("x", "recall")) == "0.8"
    assert one(spark, "ab", "string", text.surrogate_key("x", F.lit("c"))) == "900150983cd24fb0d6963f7d28e17f72"


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Air temperature [K]", "Torque  [Nm]"])
    assert text.clean_column_names(df).columns == ["Air_temperature_K", "Torque_Nm"]
    with pytest.raises(ValueError):
        text.clean_column_names(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))
