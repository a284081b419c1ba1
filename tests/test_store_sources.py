import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assetlake import schemas
from assetlake.operators import joins, store
from assetlake.plans.catalog import REGISTRY
from assetlake.sources import catalog, database, files
from assetlake.sources.kafka import KafkaSettings
from assetlake.sources.versioned import VersionedTable

NOW = datetime(2024, 1, 15, 12, 0, 0)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def offline(spark, *entries):
    data = [(e, f, v, datetime.fromisoformat(t)) for e, f, v, t in entries]
    return spark.createDataFrame(data, "equipment_id string, feature_name string, feature_value double, timestamp timestamp_ntz")


def online(spark, *entries):
    data = [(e, m, datetime.fromisoformat(t), datetime.fromisoformat(i)) for e, m, t, i in entries]
    return spark.createDataFrame(data, "equipment_id string, features map<string,double>, timestamp timestamp_ntz, ingestion_time timestamp_ntz")


def test_serving_order(spark):
    on = online(
        spark,
        ("fresh", {"t": 1.0, "x": 9.0}, "2024-01-15T11:58:00", "2024-01-15T11:58:00"),
        ("stale", {"t": 1.0}, "2024-01-15T11:00:00", "2024-01-15T11:00:00"),
        ("edge", {"t": 1.0}, "2024-01-15T11:55:00", "2024-01-15T11:55:00"),
    )
    off = offline(
        spark,
        ("stale", "t", 5.0, "2024-01-15T11:30:00"),
        ("stale", "v", None, "2024-01-15T11:30:00"),
        ("stale", "v", 7.0, "2024-01-15T10:30:00"),
        ("old", "t", 5.0, "2024-01-13T11:30:00"),
    )
    asked = spark.createDataFrame([("fresh",), ("stale",), ("edge",), ("old",)], "equipment_id string")
    got = {r["equipment_id"]: r for r in joins.serve_features(asked, on, off, ["t", "v"], now()).collect()}
    assert (got["fresh"]["source"], got["fresh"]["fresh"], got["fresh"]["features"]) == ("online_store", True, {"t": 1.0})
    assert (got["stale"]["source"], got["stale"]["features"]) == ("offline_store", {"t": 5.0})
    assert (got["edge"]["source"], got["old"]["source"], got["old"]["features"]) == ("none", "none", {})
    batch = {r["equipment_id"]: r["source"] for r in joins.serve_features(asked, on, off, ["t", "v"], now(), None).collect()}
    assert batch == {"fresh": "online_store", "stale": "online_store", "edge": "online_store", "old": "none"}


def test_online_state_prefers_event_time(spark):
    rows = online(
        spark,
        ("e", {"t": 2.0, "v": 3.0}, "2024-01-15T11:00:00", "2024-01-15T11:00:01"),
        ("e", {"t": 1.0}, "2024-01-15T10:00:00", "2024-01-15T11:30:00"),
    )
    got = store.online_state(rows).first()
    assert got["features"] == {"t": 2.0, "v": 3.0} and got["feature_count"] == 2 and got["feature_names"] == ["t", "v"]
    assert store.unexpired(store.online_state(rows), F.lit("2024-01-22 11:00:01").cast("timestamp_ntz")).count() == 0
    assert store.online_state(rows).select(store.feature_vector("features", ["v", "none", "t"]).alias("x")).first()["x"] == [3.0, 0.0, 2.0]


def test_vector_round_trip(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    assert df.select(store.vector_to_map("v", ["a", "b"]).alias("m")).first()["m"] == {"a": 1.0, "b": 2.0}


def test_ingest_keeps_rejects(spark):
    registry = store.registry_frame(spark, [{"name": "t", "type": "numeric", "validation_rules": {"max": 100}}, {"name": "v", "type": "numeric"}])
    wide = spark.createDataFrame(
        [("e", datetime(2024, 1, 1), 50.0, 1.0), ("e", datetime(2024, 1, 2), 150.0, 2.0)], "equipment_id string, timestamp timestamp_ntz, t double, v double"
    )
    valid, newest, rejected = store.ingest(wide, ["t", "v", ], registry)
    assert valid.count() == 3
    assert newest.first()["features"] == {"v": 2.0}
    assert [(r["feature_name"], r["error"]) for r in rejected.collect()] == [("t", "Value above maximum")]
    good, bad, count = store.ingest_records(wide.unionByName(wide.withColumn("equipment_id", F.lit(None).cast("string"))), ["t"])
    assert (good.count(), bad.count(), count.first()[0]) == (2, 2, 2)


def test_registry_life_cycle(spark):
    registry = store.registry_frame(spark, [{"name": "t", "type": "numeric", "transformations": ["log_transform"]}, {"name": "k", "type": "categorical"}])
    changed = store.update_definition(registry, "t", {"description": F.lit("new")}, now())
    row = store.definition(changed, "t").first()
    assert (row["version"], row["description"], row["updated_at"]) == (2, "new", NOW)
    assert store.definition(changed, "k").first()["version"] == 1
    assert [r["feature_name"] for r in store.of_type(changed, "categorical").collect()] == ["k"]
    assert store.unregister(changed, "k").count() == 1
    again = store.register(changed, store.registry_frame(spark, [{"name": "t", "type": "text"}]))
    assert again.count() == 2 and store.definition(again, "t").first()["feature_type"] == "text"
    exported = store.registry_export(registry).filter("feature_name = 't'").first()
    assert json.loads(exported["transformations"]) == ["log_transform"]
    with pytest.raises(ValueError):
        store.registry_frame(spark, [{"name": "t", "type": "unknown"}])
    with pytest.raises(ValueError):
        store.registry_frame(spark, [{"name": "t", "type": "text", "transformations": ["unknown"]}])


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 9.9, 10.0, 20.0, 21.0)], "v double")
    assert [r["b"] for r in df.select(store.bin_number("v", [0.0, 10.0, 20.0]).alias("b")).collect()] == [None, 0, 0, 1, 1, None]


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    assert table.publish(spark.range(3)) == 1
    assert table.publish(table.read().filter("id > 0")) == 2  # reads the version it replaces
    assert table.read().count() == 2 and table.read(1).count() == 3
    assert [r["rows"] for r in table.log().orderBy("version").collect()] == [3, 2]


CSV = """UDI,Product ID,Type,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],Tool wear [min],Target,Failure Type
1,M1,M,298.1,308.6,1551,42.8,0,0,No Failure
2,L1,L,298.2,308.7,1408,46.3,3,1,Power Failure
"""


def test_batch_load_and_audit(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    table, audit = str(tmp_path / "raw"), str(tmp_path / "audit")
    for _ in range(2):  # a repeated load of one batch does not double it
        files.load_batch(spark, str(tmp_path / "in.csv"), table, audit, "b1")
    loaded = spark.read.parquet(table)
    assert loaded.count() == 2 and loaded.filter("udi = '2'").first()["failure_type"] == "Power Failure"
    status = files.import_status(spark, audit).first()
    assert (status["status"], status["records_count"], status["file_size"]) == ("completed", 2, len(CSV))
    assert status["completed_at"] >= status["started_at"]
    (tmp_path / "bad.csv").write_text(CSV + "3,L1,L,warm,308.7,1408,46.3,3,1,x\n")
    with pytest.raises(Exception):
        files.load_batch(spark, str(tmp_path / "bad.csv"), table, audit, "b2")
    failed = files.import_status(spark, audit).filter("run_id = 'b2'").first()
    assert failed["status"] == "failed" and failed["error_message"]
    assert spark.read.parquet(table).count() == 2


def test_sample_and_report(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(150)], "id int, v double")
    files.write_sample(df, ["id"], str(tmp_path / "s"))
    sample = spark.read.csv(str(tmp_path / "s"), header=True, schema="id int, v double")
    assert sample.count() == 100 and sample.agg(F.max("id")).first()[0] == 99
    files.write_report(files.quality_report(df, ["v"]), str(tmp_path / "r"))
    report = spark.read.json(str(tmp_path / "r")).first()
    assert report["total_rows"] == 150 and report["value_ranges"][0]["max"] == 149.0
    files.write_prepared(df, df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p/test")).count() == 150


def test_layers(spark, tmp_path):
    for _ in range(2):
        catalog.create_layers(spark, "check_", str(tmp_path))
    assert all(spark.table(name).count() == 0 for name in catalog.layer_tables("check_"))
    row = spark.createDataFrame([("2024-01-01", "m1", "recall", 0.9)], "metric_date string, model_id string, metric_name string, metric_value double")
    full = row.select(F.col("metric_date").cast("date").alias("metric_date"), "model_id", "metric_name", "metric_value").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schemas.MODEL_METRICS if f.name not in row.columns}
    )
    catalog.append_rows(full, "check_monitoring.model_metrics")
    other = full.withColumn("metric_date", F.lit("2024-01-02").cast("date"))
    catalog.replace_partitions(other, "check_monitoring.model_metrics")
    catalog.replace_partitions(other, "check_monitoring.model_metrics")
    assert spark.table("check_monitoring.model_metrics").count() == 2
    catalog.replace_table(spark.range(2).toDF("id"), "check_monitoring.extra")
    catalog.replace_table(spark.range(1).toDF("id"), "check_monitoring.extra")
    assert spark.table("check_monitoring.extra").count() == 1
    catalog.drop_layers(spark, "check_")
    assert not any(d.name.startswith("check_") for d in spark.catalog.listDatabases())
    with pytest.raises(ValueError):
        catalog.drop_layers(spark, "")


def test_layer_query_leaves_other_tables_alone(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    for _ in range(2):
        found = REGISTRY["s03_s12_layer_tables"].run(spark, "/root/testdata/sf0.001").collect()
        assert {r["layer_tables"] for r in found} == {18} and all(r["n"] > 0 for r in found)
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_database_options():
    plain = database.scan_options("jdbc:x", "SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    split = database.scan_options("jdbc:x", "SELECT * FROM t", "id", (0, 100), 4)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        database.scan_options("jdbc:x", "SELECT 1", "id")


def test_kafka_options():
    settings = KafkaSettings.from_json('{"bootstrap_servers": ["a:1", "b:2"], "topic_name": "t", "enable_auto_commit": false, "security_protocol": "SASL_SSL", "sasl_username": "u", "sasl_password": "p"}')
    source = settings.source_options(500)
    assert source["kafka.bootstrap.servers"] == "a:1,b:2" and source["startingOffsets"] == "earliest"
    assert source["maxOffsetsPerTrigger"] == "500" and 'username="u"' in source["kafka.sasl.jaas.config"]
    assert settings.sink_options("alerts")["topic"] == "alerts"
    assert "kafka.security.protocol" not in KafkaSettings().source_options()


def days_of(path):
    return {p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")) for p in path.glob("*=*")}


def test_retention_drops_partitions_and_refresh_touches_only_its_days(spark, tmp_path):
    days = [f"2024-01-0{d}" for d in range(1, 8)]
    data = [(i, days[i % 7] + " 10:00:00", i % 3 == 0) for i in range(70)] + [(70, None, True)]
    rows = spark.createDataFrame(data, "id int, t string, ok boolean").withColumn("t", F.col("t").cast("timestamp_ntz"))

    def summarise(df):
        return df.groupBy("period").agg(F.count(F.lit(1)).alias("n")).select("n", "period")

    spark.sql(f"CREATE DATABASE keep_days LOCATION '{tmp_path}/db'")
    try:
        name, first = "keep_days.raw", date(2024, 1, 4)
        catalog.create_dated_table(rows, name, "t")
        summarise(spark.table(name).filter("period IS NOT NULL")).write.partitionBy("period").saveAsTable("keep_days.daily")
        raw, daily = tmp_path / "db/raw", tmp_path / "db/daily"
        before = days_of(raw)
        assert [str(d) for d in catalog.periods(spark, name)] == days
        assert [str(d) for d in catalog.drop_before(spark, name, first, "t")] == days[:3]
        after = days_of(raw)
        assert {k for k in before if k not in after} == {f"period={d}" for d in days[:3]}
        assert all(after[k] == before[k] for k in after)  # what is kept is not written again
        kept = {r["id"] for r in spark.table(name).collect()}
        assert kept == {i for i in range(70) if i % 7 >= 3} | {70}
        assert catalog.drop_before(spark, name, first, "t") == []

        more = spark.createDataFrame([(100, days[4])], "id int, day string").select(
            "id", F.col("day").cast("timestamp_ntz").alias("t"), F.lit(True).alias("ok"), F.col("day").cast("date").alias("period")
        )
        catalog.append_rows(more, name)
        before = days_of(daily)
        catalog.refresh_periods(spark, name, "keep_days.daily", [date(2024, 1, 5), date(2024, 1, 1)], summarise)
        after = days_of(daily)
        assert set(before) - set(after) == {f"period={days[0]}"}
        assert {k for k in after if after[k] != before[k]} == {f"period={days[4]}"}
        counts = {str(r["period"]): r["n"] for r in spark.table("keep_days.daily").collect()}
        assert counts == {d: 11 if d == days[4] else 10 for d in days[1:]}
        catalog.refresh_periods(spark, name, "keep_days.daily", [], summarise)
        assert days_of(daily) == after

        monthly = rows.withColumn("t", F.expr("t + make_interval(0, id % 3)"))  # three months, the second is cut
        catalog.create_dated_table(monthly, "keep_days.monthly", "t", "month")
        before = days_of(tmp_path / "db/monthly")
        assert catalog.drop_before(spark, "keep_days.monthly", date(2024, 2, 4), "t", "month") == [date(2024, 1, 1)]
        after = days_of(tmp_path / "db/monthly")
        assert set(before) - set(after) == {"period=2024-01-01"}
        assert {k for k in after if after[k] != before[k]} == {"period=2024-02-01"}
        assert {r["id"] for r in spark.table("keep_days.monthly").collect()} == {
            i for i in range(70) if i % 3 == 2 or (i % 3 == 1 and i % 7 >= 3)
        } | {70}
    finally:
        spark.sql("DROP DATABASE keep_days CASCADE")
