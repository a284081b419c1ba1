import json
import random
import statistics
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from assetlake.learning import models
from assetlake.operators import features as feat
from assetlake.operators import store
from assetlake.plans import queries_streaming
from assetlake.plans.catalog import REGISTRY
from assetlake.sources.versioned import VersionedTable
from assetlake.streaming import messages, progress, scoring, sinks, state, windows


def message(number, machine, ts, **data):
    return json.dumps({"equipment_id": machine, "timestamp": ts, "data": data, "message_id": f"m{number}"})


GOOD = [
    message(1, "EQ-1", "2024-01-15T10:30:00Z", temperature=85.5, vibration=42.3, pressure=120.8, note="x", code="12"),
    message(2, "EQ-1", "2024-01-15T10:30:10Z", temperature=95, vibration=41, pressure=119),
    message(3, "EQ-1", "2024-01-15T10:30:20Z", temperature=75, vibration=40, pressure=110),
]
BAD = [message(4, "EQ-2", "bad", temperature=75), "not json", message(5, "", "2024-01-15T10:30:20Z", temperature=75), message(6, "EQ-2", "2024-01-15T10:30:20Z", note="text")]


@pytest.fixture
def source(spark, tmp_path):
    """Writes lines as files of a stream and opens the stream."""
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, lines):
        (folder / name).write_text("\n".join(lines))

    return put, lambda: messages.parse(spark.readStream.text(str(folder)))


def run(spark, tmp_path, name, stream, **options):
    query = sinks.run_available(stream, str(tmp_path / f"{name}-state"), path=str(tmp_path / name), **options)
    return query, spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_parse_keeps_numbers_and_splits(spark):
    parsed = messages.parse(spark.createDataFrame([(m,) for m in GOOD + BAD], "value string"))
    good, bad = messages.split_usable(parsed)
    assert good.count() == 3 and bad.count() == 4
    assert good.filter("message_id = 'm1'").first()["data"] == {"temperature": 85.5, "vibration": 42.3, "pressure": 120.8}


def test_validation_and_enrichment(spark):
    lines = GOOD + [message(7, "EQ-3", "2024-01-13T23:00:00Z", temperature=200, vibration=1, pressure=1), message(8, "EQ-3", "2024-01-13T23:00:00Z", temperature="hot", vibration=1, pressure=1)]
    parsed = messages.parse(spark.createDataFrame([(m,) for m in lines], "value string"))
    valid, refused = messages.validate(messages.with_sensor_columns(messages.split_usable(parsed)[0]))
    assert {r["message_id"]: r["reasons"] for r in refused.collect()} == {"m7": ["temperature out of range"], "m8": ["missing temperature"]}
    row = messages.enrich(valid).filter("message_id = 'm2'").first()
    assert (row["hour"], row["day_of_week"], row["month"], row["is_weekend"]) == (10, 0, 1, 0)
    assert row["temperature_pressure_ratio"] == pytest.approx(95 / 119) and row["vibration_energy"] == 1681.0


def test_windows_stream_equals_batch(spark, tmp_path, source):
    put, stream = source
    late_marker = message(9, "EQ-9", "2024-01-15T11:00:00Z", temperature=1, vibration=1, pressure=1)
    put("a.txt", GOOD + [late_marker])
    closed = windows.with_alert_level(windows.stream_statistics(messages.series(messages.split_usable(stream())[0])))
    _, out = run(spark, tmp_path, "w", closed)
    parsed = messages.parse(spark.createDataFrame([(m,) for m in GOOD], "value string"))
    batch = windows.with_alert_level(windows.batch_statistics(messages.series(parsed)))
    columns = [*windows.KEYS, "count", "mean", "median", "std", "min", "max", "range", "alert_level"]
    def rounded(frame):
        return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.select(columns).collect()}

    got, want = rounded(out.filter("equipment_id = 'EQ-1'")), rounded(batch)
    assert got == want and len(got) == 24
    peak = batch.filter("sensor = 'temperature' AND window_start = '2024-01-15 10:30:00'").first()
    assert (peak["count"], peak["median"], peak["max"], peak["alert_level"]) == (3, 85.5, 95.0, "critical")
    single = batch.filter("sensor = 'temperature' AND window_start = '2024-01-15 10:29:10'").first()
    assert (single["std"], single["alert_level"]) == (0.0, "warning")


def test_anomalies_alerts_and_envelope(spark):
    rows = [("EQ-1", "temperature", 50.0 + i % 2, f"2024-01-15 10:30:{i:02d}") for i in range(30)] + [("EQ-1", "temperature", 91.0, "2024-01-15 10:30:31")]
    series = spark.createDataFrame(rows, "equipment_id string, sensor string, value double, t string").withColumn("event_time", F.col("t").cast("timestamp"))
    found = windows.batch_anomalies(series).filter("window_start = '2024-01-15 10:30:00'").collect()
    assert [r["value"] for r in found] == [91.0]
    statistics = windows.batch_statistics(series).filter("window_start = '2024-01-15 10:30:00'")
    alert = windows.threshold_alerts(statistics).first()
    assert alert["alert_id"] == "alert_EQ-1_temperature_20240115103000_critical"
    assert alert["message"] == "temperature critical alert: 91.00"
    envelope = windows.envelope(windows.with_alert_level(statistics)).first()
    assert envelope["results"]["temperature"]["count"] == 31 and envelope["aggregation_period"] == 60


def test_late_rows_are_dropped_and_counted(spark, tmp_path, source):
    put, stream = source
    closed = windows.stream_statistics(messages.series(messages.split_usable(stream())[0]))
    put("a.txt", GOOD + [message(9, "EQ-9", "2024-01-15T11:00:00Z", temperature=1)])
    run(spark, tmp_path, "l", closed)
    put("b.txt", [message(10, "EQ-1", "2024-01-15T10:30:30Z", temperature=1)])
    query, out = run(spark, tmp_path, "l", closed)
    assert out.filter("equipment_id = 'EQ-1' AND sensor = 'temperature' AND min < 2").count() == 0
    assert progress.late_rows(query) > 0


def test_restart_continues_and_duplicates_are_dropped(spark, tmp_path, source):
    put, stream = source
    unique = messages.deduplicate(messages.split_usable(stream())[0]).select("message_id")
    put("a.txt", GOOD + GOOD[:1])
    run(spark, tmp_path, "d", unique)
    put("b.txt", GOOD[2:] + [message(11, "EQ-1", "2024-01-15T10:30:25Z", temperature=1)])
    _, out = run(spark, tmp_path, "d", unique)
    assert sorted(r["message_id"] for r in out.collect()) == ["m1", "m11", "m2", "m3"]


def test_history_state_survives_a_restart_and_matches_batch(spark, tmp_path, source):
    put, stream = source
    lines = [message(i, "EQ-1", f"2024-01-15T10:30:{i:02d}Z", temperature=float(i * i), vibration=1, pressure=1) for i in range(14)]
    rows = state.with_history(messages.with_sensor_columns(messages.split_usable(stream())[0]), ["temperature"])
    put("a.txt", lines[:6][::-1])  # out of order inside one batch
    run(spark, tmp_path, "h", rows)
    put("b.txt", [*lines[6:], message(99, "EQ-9", "2024-01-15T11:00:00Z", temperature=1, vibration=1, pressure=1)])
    _, out = run(spark, tmp_path, "h", rows)
    parsed = messages.with_sensor_columns(messages.parse(spark.createDataFrame([(m,) for m in lines], "value string")))
    batch = feat.history_features(parsed.select("equipment_id", "event_time", "temperature"), ["equipment_id"], ["event_time"], ["temperature"])
    columns = ["event_time", "temperature_rolling_mean_3", "temperature_trend"]
    got = [tuple(r) for r in out.select(columns).orderBy("event_time").collect()]
    want = [tuple(r) for r in batch.select(columns).orderBy("event_time").collect()]
    assert len(got) == 14
    for (t1, m1, d1), (t2, m2, d2) in zip(got, want):
        assert t1 == t2 and m1 == pytest.approx(m2) and d1 == pytest.approx(d2)


def test_latest_features_ignores_older_events(spark, tmp_path, source):
    put, stream = source
    rows = state.latest_features(messages.with_sensor_columns(messages.split_usable(stream())[0]), ["temperature"], None)
    seen = []

    def write(batch, _):
        seen.extend((r["equipment_id"], r["temperature"]) for r in batch.collect())

    put("a.txt", GOOD)
    sinks.run_available(rows, str(tmp_path / "s"), foreach_batch=write)
    put("b.txt", [message(12, "EQ-1", "2024-01-15T10:29:00Z", temperature=1), message(13, "EQ-2", "2024-01-15T10:29:00Z", temperature=2)])
    sinks.run_available(rows, str(tmp_path / "s"), foreach_batch=write)
    assert seen == [("EQ-1", 75.0), ("EQ-2", 2.0)]


def test_fan_out_is_idempotent(spark, tmp_path):
    parsed = messages.parse(spark.createDataFrame([(m,) for m in GOOD + BAD], "value string"))
    write = sinks.fan_out(sinks.sensor_targets(), str(tmp_path / "fan"))
    for _ in range(2):
        write(parsed, 7)
    sizes = {n: spark.read.parquet(str(tmp_path / "fan" / n)).count() for n in ("offline", "online", "raw", "refused")}
    assert sizes == {"offline": 27, "online": 1, "raw": 7, "refused": 4}


def test_online_upsert_keeps_the_newest(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "online"))
    write = sinks.upsert_online(table)

    def batch(value, ts):
        return spark.createDataFrame([("e", {"t": value}, ts)], "equipment_id string, features map<string,double>, t string").select(
            "equipment_id", "features", F.col("t").cast("timestamp").alias("timestamp"), F.current_timestamp().alias("ingestion_time")
        )

    write(batch(1.0, "2024-01-15 10:00:00"), 0)
    write(batch(2.0, "2024-01-15 11:00:00"), 1)
    write(batch(3.0, "2024-01-15 10:30:00"), 2)
    assert table.read().first()["features"] == {"t": 2.0}
    assert store.online_state(table.read()).count() == 1


def test_keyed_json(spark):
    sent = sinks.keyed_json(spark.createDataFrame([("e", 1.0)], "equipment_id string, v double")).first()
    body = json.loads(sent["value"])
    assert sent["key"] == "e" and body["v"] == 1.0 and body["message_id"] and body["producer_timestamp"]


def test_window_values_match_readings():
    rng = random.Random(1)
    for size in (1, 2, 3, 10, 61):
        values = [round(rng.gauss(20, 3), 1) for _ in range(size)] + ([500.0] if size == 61 else [])
        count, mean, median, std, low, high, spread, apart = state.window_values(Counter(values))
        assert (count, low, high) == (len(values), min(values), max(values)) and spread == high - low
        assert mean == pytest.approx(statistics.fmean(values)) and median == pytest.approx(statistics.median(values))
        assert std == pytest.approx(statistics.stdev(values) if len(values) > 1 else 0.0)
        assert sorted(apart) == sorted(v for v in values if std > 0 and abs(v - mean) > 3 * std)


def test_window_plan_keeps_no_lists(spark, source):
    _, stream = source
    closed = windows.stream_statistics(messages.series(messages.split_usable(stream())[0]))
    plan = closed._jdf.queryExecution().analyzed().toString()
    assert "collect_list" not in plan and "percentile" not in plan and "TransformWithState" in plan


def test_window_resolution_bounds_the_values(spark, tmp_path, source):
    put, stream = source
    lines = [message(i, "EQ-1", f"2024-01-15T10:30:0{i}Z", temperature=20 + i / 1000) for i in range(9)]
    put("a.txt", lines + [message(9, "EQ-9", "2024-01-15T11:00:00Z", temperature=1)])
    closed = windows.stream_statistics(messages.series(messages.split_usable(stream())[0]), resolution=0.5)
    _, out = run(spark, tmp_path, "r", closed)
    got = out.filter("equipment_id = 'EQ-1'").collect()
    assert len(got) == 6 and all((r["count"], r["median"], r["std"]) == (9, 20.0, 0.0) for r in got)


def test_held_late_and_evicted(spark, tmp_path, source):
    put, stream = source

    def at(number, second, minute=30):
        return message(number, "EQ-1", f"2024-01-15T10:{minute}:{second:02d}Z", temperature=number)

    held = state.held_readings(messages.series(messages.split_usable(stream())[0]))
    put("a.txt", [at(1, 0), at(2, 50)])
    run(spark, tmp_path, "k", held)
    put("b.txt", [at(3, 20, 31)])  # the watermark goes to 10:31:20, past the minute of the first
    run(spark, tmp_path, "k", held)
    put("c.txt", [at(4, 20), at(5, 21), at(6, 30)])  # ended at 10:31:20, is held until 10:31:21 and 10:31:30
    run(spark, tmp_path, "k", held)
    put("d.txt", [at(7, 30, 31)])
    _, out = run(spark, tmp_path, "k", held)
    got = {status: sorted(int(r["value"]) for r in out.filter(F.col("status") == status).collect()) for status in ("kept", "late", "evicted")}
    assert got == {"kept": [1, 2, 3, 5, 6, 7], "late": [4], "evicted": [1, 5, 6]}


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The smallest tables, the streamed ones as four files each, dealt without regard to time."""
    folder = tmp_path_factory.mktemp("split")
    for name in ("events", "lineitem"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(4).write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


STREAMS = ["x05_stream_statistics", "x06_stream_anomalies", "x07_stream_history", "x08_stream_alerts", "x14_stream_deduplication", "x15_stream_throughput", "x13_score_cache"]


@pytest.mark.parametrize("name", STREAMS)
def test_results_do_not_depend_on_micro_batches(spark, rows, monkeypatch, split_tables, name):
    monkeypatch.setattr(queries_streaming, "FILES_PER_TRIGGER", 1)
    in_four = REGISTRY[name].run(spark, split_tables)
    columns = sorted(in_four.columns)
    got = rows(in_four, *columns)
    db = duckdb.connect()
    for table in ("events", "lineitem"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({REGISTRY[name].oracle()}) q").fetchall()
    assert len(got) > 0 and got == sorted(want, key=repr)


def test_held_readings_reach_the_state_in_chunks():
    class Handle:
        def __init__(self):
            self.sizes, self.timers = [], []

        def getListState(self, name, schema):
            return self

        def appendList(self, values):
            self.sizes.append(len(values))

        def registerTimer(self, at):
            self.timers.append(at)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 100_000

    handle, held = Handle(), state.HeldReadings(60_000)
    held.init(handle)
    out = list(held.handleInputRows(("e", "s", 0), ({"event_us": 30_000_000 + i * 1000, "value": 1.0} for i in range(35_000)), Times()))
    assert sum(r["status"] == "late" for r in out) == 10_001 and len(out) == 35_000
    assert sum(handle.sizes) == 24_999 and max(handle.sizes) <= 10_000 and handle.timers == [100_001]


def test_held_series_is_cut_into_slots(spark, source):
    _, stream = source
    plan = state.held_readings(messages.series(messages.split_usable(stream())[0]))._jdf.queryExecution().analyzed().toString()
    assert "slot" in plan


def check_against_oracle(spark, rows, name, folder):
    found = REGISTRY[name].run(spark, folder)
    columns = sorted(found.columns)
    db = duckdb.connect()
    db.execute("CREATE VIEW lineitem AS SELECT * FROM '/root/testdata/sf0.001/lineitem.parquet'")
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({REGISTRY[name].oracle()}) q").fetchall()
    assert rows(found, *columns) == sorted(want, key=repr)


def test_messages_are_validated_in_one_stream(spark, rows, monkeypatch, split_tables):
    started, run_stream = [], sinks.run_available
    monkeypatch.setattr(sinks, "run_available", lambda *a, **k: started.append(1) or run_stream(*a, **k))
    check_against_oracle(spark, rows, "x01_x03_stream_validation", split_tables)
    assert len(started) == 1


def test_judged_messages_equal_the_parted_ones(spark):
    parsed = messages.parse(spark.createDataFrame([(m,) for m in GOOD + BAD], "value string"))
    judged = messages.judge(messages.with_sensor_columns(parsed))
    usable, unusable = messages.split_usable(parsed)
    valid, refused = messages.validate(messages.with_sensor_columns(usable))
    def texts(frame, *columns):
        return sorted(map(repr, frame.select("raw", *columns).collect()))

    assert texts(judged.filter("usable AND size(reasons) = 0")) == texts(valid)
    assert texts(judged.filter("usable AND size(reasons) > 0"), "reasons") == texts(refused, "reasons")
    assert texts(judged.filter("NOT usable")) == texts(unusable)


def test_throughput_persists_what_it_counts_and_writes(spark, rows, monkeypatch, split_tables):
    seen, metered = [], progress.metered

    def watched(write, path, failed):
        run_batch = metered(write, path, failed)
        return lambda batch, batch_id: seen.append(set(batch.columns)) or run_batch(batch, batch_id)

    monkeypatch.setattr(progress, "metered", watched)
    check_against_oracle(spark, rows, "x15_stream_throughput", split_tables)
    assert seen and all(columns == {"message_id", "failed"} for columns in seen)


def test_fan_out_spreads_a_large_file(spark, rows, monkeypatch):
    parts, fan_out = [], sinks.fan_out

    def watched(targets, base):
        write = fan_out(targets, base)

        def run_batch(batch, batch_id):
            parts.extend(batch.rdd.glom().map(len).collect())
            write(batch, batch_id)

        return run_batch

    monkeypatch.setattr(sinks, "fan_out", watched)
    monkeypatch.setattr(queries_streaming, "ROWS_PER_TASK", 1000)
    check_against_oracle(spark, rows, "s07_x12_stream_fan_out", "/root/testdata/sf0.001")
    assert sum(parts) > 5000 and max(parts) <= 1100


def test_throughput_adds_up_all_batches(spark, tmp_path, source):
    put, stream = source
    write = progress.metered(lambda b, i: sinks.replace_batch(b.select("raw"), str(tmp_path / "out"), i), str(tmp_path / "m"), ~messages.usable())
    for name, lines in {"a.txt": GOOD, "b.txt": BAD, "c.txt": GOOD[:1]}.items():
        put(name, lines)
        sinks.run_available(stream(), str(tmp_path / "s"), foreach_batch=write)
    total = progress.throughput(spark, str(tmp_path / "m")).first()
    assert (total["batches"], total["processed"], total["failed"]) == (3, 4, 4)
    assert 0 < total["min_batch_s"] <= total["avg_batch_s"] <= total["max_batch_s"]
    write(messages.parse(spark.createDataFrame([(GOOD[0],)], "value string")), 2)  # a replay replaces its row
    assert progress.throughput(spark, str(tmp_path / "m")).first()["processed"] == 4


def test_score_cache_forgets_after_its_time(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "request_id string, x double").coalesce(1).write.parquet(str(folder))
    schema = "request_id string, x double"
    scored = state.cached_scores(spark.readStream.schema(schema).parquet(str(folder)), lambda row: row[0] / 10, ["x"], ttl_ms=1)
    seen = []
    query = scored.writeStream.foreachBatch(lambda b, i: seen.extend(tuple(r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "s")).trigger(processingTime="1 second").start()

    def wait_for(n):  # with a time-to-live there is always another batch, so the stream is never idle
        until = time.time() + 60
        while len(seen) < n and time.time() < until:
            time.sleep(0.2)

    wait_for(3)
    spark.createDataFrame([("d", 2.0)], schema).coalesce(1).write.mode("append").parquet(str(folder))
    wait_for(4)
    query.stop()
    assert {(i, p) for i, p, _ in seen} == {("a", 0.1), ("b", 0.1), ("c", 0.2), ("d", 0.2)}
    assert sorted(hit for i, _, hit in seen if i in "ab") == [False, True] and not dict((i, h) for i, _, h in seen)["d"]


def test_linear_predictor_equals_the_model(spark):
    data = spark.range(200).selectExpr("cast(id % 7 as double) AS x", "cast(id % 11 as double) AS y", "cast(id % 7 > 3 and id % 5 > 0 as int) AS label")
    model = models.fit(data, models.logistic_regression(["x", "y"]))
    predict = scoring.linear_predictor(model)
    assert all(r["p"] == pytest.approx(predict([r["x"], r["y"]]), abs=1e-12) for r in models.score(model, data).collect())


def test_a_large_batch_is_made_and_kept_in_parts(spark, rows, tmp_path):
    spark.range(3000).selectExpr("id", "id % 7 AS entity").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, entity long").parquet(str(tmp_path / "in"))
    text = F.format_string('{"equipment_id": "e%d", "timestamp": "2024-01-01T00:00:00Z", "message_id": "%d", "data": {"temperature": 20, "vibration": 1, "pressure": 5}}', "entity", "id")
    seen, fan = [], sinks.fan_out(sinks.sensor_targets(), str(tmp_path / "out"))

    def write(batch, number):
        seen.append((number, batch.count(), batch.rdd.getNumPartitions()))
        fan(batch, number)

    run = sinks.in_parts(write, lambda part: messages.parse(part.select(text.alias("value"))), 250, 1000)
    sinks.run_available(stream, str(tmp_path / "state"), foreach_batch=run)
    sizes = [n for _, n, _ in seen]
    assert len(sizes) == 3 and sum(sizes) == 3000 and max(sizes) < 1200 and all(tasks == 4 for *_, tasks in seen)
    first = list(seen)
    run(spark.read.parquet(str(tmp_path / "in")), 0)  # a replay makes and overwrites the same parts
    assert seen[3:] == first
    raw = spark.read.parquet(str(tmp_path / "out" / "raw"))
    assert rows(raw, F.col("message_id").cast("int")) == sorted(((i,) for i in range(3000)), key=repr)
    assert spark.read.parquet(str(tmp_path / "out" / "online")).select("equipment_id").distinct().count() == 7


def test_fan_out_query_holds_part_of_a_large_file(spark, rows, monkeypatch, split_tables):
    held, fan_out = [], sinks.fan_out

    def watched(targets, base):
        write = fan_out(targets, base)
        return lambda batch, number: held.append(batch.count()) or write(batch, number)

    monkeypatch.setattr(sinks, "fan_out", watched)
    monkeypatch.setattr(queries_streaming, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(queries_streaming, "ROWS_PER_PART", 2000, raising=False)
    check_against_oracle(spark, rows, "s07_x12_stream_fan_out", split_tables)
    assert sum(held) > 5000 and max(held) < 3000
