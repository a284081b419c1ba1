import json

import pytest
from pyspark.sql import functions as F

from assetlake.operators import features as feat
from assetlake.operators import joins, store, tables
from assetlake.operators import validation as val
from assetlake.plans import medallion

RAW = "id long, udi string, product_id string, equipment_type string, air_temperature_k double, process_temperature_k double, rotational_speed_rpm int, torque_nm double, tool_wear_min int, target int, failure_type string, timestamp string, batch_id string"
GOOD = (300.0, 310.0, 1500, 40.0, 100)


def raw(spark, *records):
    """records: (id, udi, measures, target, batch)"""
    data = [(i, u, "L1", "L", *m, t, "No Failure" if t == 0 else "Power Failure", f"2024-01-01 00:00:{i:02d}", b) for i, u, m, t, b in records]
    return spark.createDataFrame(data, RAW).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_cleaning_keeps_first_masks_and_flags(spark):
    df = raw(
        spark,
        (2, "a", (300.0, 310.0, 1500, 40.0, 250), 1, "b1"),
        (1, "a", GOOD, 0, "b1"),
        (3, "b", (280.0, 310.0, 1500, 40.0, 100), 0, "b1"),
        (4, "c", (300.0, 310.0, 1500, None, 100), 0, "b2"),
        (5, "d", (290.0, 320.0, 3000, 100.0, 300), 0, "b2"),
    )
    got = {r["udi"]: r for r in medallion.clean_and_validate(df).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"]["id"] == 1 and got["a"]["tool_wear_min"] == 100
    assert got["b"]["air_temperature_k"] is None and got["b"]["is_valid"] and not got["b"]["passes_rules"]
    assert not got["c"]["is_valid"] and not got["c"]["passes_rules"]
    assert got["d"]["passes_rules"] and got["d"]["tool_wear_min"] == 300
    errors = json.loads(got["c"]["validation_errors"])
    assert errors["torque_invalid"] is None and errors["air_temp_invalid"] is False
    assert json.loads(got["b"]["validation_errors"])["air_temp_invalid"] is True
    assert medallion.clean_and_validate(df, "b2").count() == 2


def test_quarantine_split_keeps_every_row(spark):
    df = raw(spark, (1, "a", GOOD, 0, "b"), (2, "b", (280.0, 340.0, 1500, 40.0, 100), 0, "b"), (3, "c", (300.0, 310.0, 1500, None, 1), 5, "b"))
    valid, rejected = val.split_by_rules(df, val.EQUIPMENT_RULES, {"target": ~F.col("target").isin(0, 1)})
    assert [r["udi"] for r in valid.collect()] == ["a"]
    assert {r["udi"]: r["broken_rules"] for r in rejected.collect()} == {"b": ["air_temp_invalid", "process_temp_invalid"], "c": ["target"]}


SENSOR = "temperature double, vibration double, pressure double"


@pytest.mark.parametrize(
    "t, v, p, errors",
    [
        (85.5, 42.3, 120.8, []),
        (0.0, 0.0, 0.0, []),
        (150.0, 100.0, 200.0, []),
        (200.0, 42.0, 120.0, ["temperature out of range"]),
        (80.0, -10.0, 120.0, ["vibration out of range"]),
        (80.0, 10.0, None, ["missing pressure"]),
    ],
)
def test_sensor_rules(spark, t, v, p, errors):
    df = spark.createDataFrame([(t, v, p)], SENSOR)
    assert df.select(val.sensor_errors().alias("e")).first()["e"] == errors


def test_relationship_rules(spark):
    df = spark.createDataFrame([(120.0, 10.0, 30.0), (59.0, 71.0, 100.0), (85.5, 42.3, 30.0), (100.0, 70.0, 50.0)], SENSOR)
    got = df.select(val.relationship_errors().alias("e"), val.relationship_warnings().alias("w")).collect()
    assert [len(r["e"]) for r in got] == [1, 1, 0, 0]
    assert [len(r["w"]) for r in got] == [0, 0, 1, 0]
    assert "sensor" in got[2]["w"][0] and "pressure" in got[2]["w"][0]


@pytest.mark.parametrize(
    "ident, kind, ts, errors",
    [
        ("EQ-001", "pump", "2024-01-09 00:00:00", []),
        ("X-1", "pump", "2024-01-09 00:00:00", ["id prefix"]),
        ("EQ", "pump", "2024-01-09 00:00:00", ["id length", "id prefix"]),
        ("EQ-001", "lathe", "2024-01-10 00:00:01", ["type", "future timestamp"]),
        ("EQ-001", "pump", "2024-01-02 23:59:59", ["too old"]),
        ("EQ-001", "pump", "2024-01-03 00:00:00", []),
    ],
)
def test_request_rules(spark, ident, kind, ts, errors):
    df = spark.createDataFrame([(ident, kind, ts)], "equipment_id string, equipment_type string, timestamp string")
    assert df.select(val.request_errors("2024-01-10 00:00:00").alias("e")).first()["e"] == errors


@pytest.mark.parametrize("x, part", [(50.0, None), (-10.0, "less than minimum"), (150.0, "greater than maximum"), (0.0, None), (100.0, None)])
def test_range_message(spark, x, part):
    message = spark.createDataFrame([(x,)], "x double").select(val.range_message("x", 0, 100).alias("m")).first()["m"]
    assert message is None if part is None else part in message


def test_batch_size(spark):
    df = spark.range(1001).select(F.lit("big").alias("batch_id")).unionByName(spark.createDataFrame([("small",)], "batch_id string"))
    assert {r["batch_id"]: r["size_ok"] for r in val.batch_size_check(df).collect()} == {"big": False, "small": True}


def test_registry_validation(spark):
    registry = store.registry_frame(
        spark,
        [
            {"name": "temperature", "type": "numeric", "validation_rules": {"min": 0, "max": 150}},
            {"name": "kind", "type": "categorical", "validation_rules": {"allowed_values": ["pump"]}},
        ],
    )
    values = spark.createDataFrame(
        [("e1", "temperature", "20"), ("e1", "temperature", "-1"), ("e1", "temperature", "hot"), ("e1", "kind", "fan"), ("e2", "kind", "pump"), ("e2", "other", "1")],
        "equipment_id string, feature_name string, feature_value string",
    )
    checked = val.validate_against_registry(values, registry)
    got = {(r["feature_name"], r["feature_value"]): r["error"] for r in checked.collect()}
    assert got == {
        ("temperature", "20"): None,
        ("temperature", "-1"): "Value below minimum",
        ("temperature", "hot"): "Expected numeric",
        ("kind", "fan"): "Value not in allowed values",
        ("kind", "pump"): None,
        ("other", "1"): "Feature not found",
    }
    assert not any(r["all_valid"] for r in val.entity_validity(checked).collect())


def test_engineered_columns(spark):
    df = raw(spark, (1, "a", GOOD, 0, "b"), (2, "b", (300.0, 310.0, 0, 40.0, 100), 0, "b"))
    got = df.withColumns(feat.engineered_columns()).orderBy("id").collect()
    assert got[0]["temperature_difference"] == 10.0
    assert got[0]["torque_speed_ratio"] == pytest.approx(40 / 1500) and got[1]["torque_speed_ratio"] == 0.0
    assert got[0]["power_estimate"] == pytest.approx(40 * 1500 / 9549.3)
    assert got[0]["temp_wear_interaction"] == 1000.0


def test_scaling_conventions(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "x double, c double")
    z = [r["x_normalized"] for r in feat.z_score(df, ["x", "c"]).orderBy("x").collect()]
    assert z == pytest.approx([-1.0, 0.0, 1.0])
    assert feat.z_score(df, ["c"]).first()["c_normalized"] is None
    scaled = feat.standard_scale(df, ["x", "c"]).orderBy("x").collect()
    assert scaled[2]["x"] == pytest.approx(1.224745, abs=1e-6) and scaled[0]["c"] == 0.0


def test_cleaning_of_outliers_is_sequential_and_keeps_nulls(spark):
    values = [(float(v), 0.0) for v in (1, 2, 3, 4, 5)] + [(100.0, 0.0), (None, 0.0)]
    df = spark.createDataFrame(values, "a double, b double")
    kept = feat.drop_iqr_outliers(df, ["a", "b"])
    assert sorted(str(r["a"]) for r in kept.collect()) == ["1.0", "2.0", "3.0", "4.0", "5.0", "None"]
    assert feat.impute_medians(df, ["a"]).filter("a IS NULL").count() == 0


@pytest.mark.parametrize(
    "values, anomalies", [([10, 11, 10.5, 11.5, 10.8], []), ([10, 11, 10.5, 11.5, 50.0], [50.0]), ([10, 11], []), ([80.0, 82.0, 81.5, 150.0], [150.0])]
)
def test_history_anomalies(spark, values, anomalies):
    df = spark.createDataFrame([("e", float(v)) for v in values], "k string, v double")
    marked = feat.history_anomalies(df, ["k"], "v")
    assert [r["v"] for r in marked.filter("is_anomaly").collect()] == anomalies


def test_sigma_needs_more_than_ten_points(spark):
    ten = spark.createDataFrame([("e", 1.0)] * 9 + [("e", 100.0)], "k string, v double")
    twenty = spark.createDataFrame([("e", 1.0)] * 19 + [("e", 100.0)], "k string, v double")
    assert feat.sigma_outliers(ten, ["k"], "v").filter("is_anomaly").count() == 0
    assert feat.sigma_outliers(twenty, ["k"], "v").filter("is_anomaly").count() == 1


def test_latest_and_first_rows(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    assert rows(tables.latest_per_key(df, ["k"], ["t", "v"])) == [("a", 2, "z"), ("b", 1, None)]
    odd = spark.createDataFrame([("a", None, "x"), ("a", 1, "p"), ("a", 1, "q"), ("b", None, "r"), (None, 3, "s"), (None, 2, "t")], df.schema)
    assert rows(tables.latest_per_entity(odd, "k", ["t", "v"])) == rows(tables.latest_per_key(odd, ["k"], ["t", "v"]))
    assert rows(tables.latest_per_entity(df.limit(0), "k", ["t"])) == []
    assert rows(tables.first_per_key(df, ["k"], ["t"])) == [("a", 1, "x"), ("b", 1, None)]


def test_delete_using(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, udi string")
    assert rows(tables.remove_duplicates_of_first(df, ["udi"], "id")) == [(1, "a"), (3, "b")]


def test_upserts(spark, rows):
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, seq int, v int")
    new = spark.createDataFrame([("a", 2, 11), ("b", 0, 21), ("c", 1, 30)], "k string, seq int, v int")
    assert rows(tables.upsert(old, new, ["k"], "seq")) == [("a", 2, 11), ("b", 1, 20), ("c", 1, 30)]
    registry = spark.createDataFrame([("a", "old", 1, 1)], "k string, v string, created_at int, updated_at int")
    change = spark.createDataFrame([("a", "new", 9), ("b", "first", 9)], "k string, v string, created_at int")
    assert rows(tables.upsert_replace(registry, change, ["k"], F.lit(5))) == [("a", "new", 1, 5), ("b", "first", 9, 5)]


def test_model_promotion(spark, rows):
    kind = "model_id string, model_type string, is_production boolean, created_at int, updated_at int, training_date int"
    old = spark.createDataFrame([("m1", "gbt", True, 1, 1, 1), ("m2", "rf", True, 1, 1, 1)], kind)
    new = spark.createDataFrame([("m3", "gbt", True, 2, 2)], "model_id string, model_type string, is_production boolean, created_at int, training_date int")
    got = tables.promote_model(old, new, F.lit(3))
    assert rows(got, "model_id", "is_production") == [("m1", False), ("m2", True), ("m3", True)]


def test_unknown_and_orphans(spark, rows):
    facts = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    master = spark.createDataFrame([("a",)], "k string")
    assert rows(joins.unknown_entities(facts.filter("k IS NOT NULL"), master, "k")) == [("x", "not found"), ("x", "not found")]
    assert rows(joins.orphan_counts([("r", facts, "k", master, "k")])) == [("r", 1, 2)]
