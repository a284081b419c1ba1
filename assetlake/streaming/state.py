"""Keyed state processors: windows from panes, held and late readings, reading history, score cache, latest features."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HISTORY_DEPTH = 10  # fixed value
ONLINE_TTL_MS = 7 * 24 * 3600 * 1000  # fixed value: seven days
SCORE_TTL_MS = 5 * 60 * 1000
SLOTS = 6  # time slots a held window is cut into; a series' slot has a state of its own
CHUNK = 10_000  # readings handed to the state at once
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def row_of(schema: str) -> Row:
    """Constructor of rows with the field names of a schema text."""
    return Row(*[field.split()[0] for field in schema.split(", ")])


WINDOW_SCHEMA = (
    "equipment_id string, sensor string, start_ms long, end_ms long, count long, mean double, median double, std double, "
    "min double, max double, range double, anomalies array<double>"
)
HELD_SCHEMA = "equipment_id string, sensor string, event_us long, value double, status string"
HELD_ROW = row_of(HELD_SCHEMA)
CACHED_SCHEMA = "request_id string, failure_probability double, cached boolean"


class PaneWindows(StatefulProcessor):
    """Sliding windows of one series, merged from panes of ``slide_ms``.

    A pane is kept as its distinct values and their counts. When the watermark passes a window's end, the panes inside
    are merged to the window's statistics and its 3-sigma anomalies; the pane that no later window needs is dropped.
    """

    def __init__(self, window_ms: int, slide_ms: int):
        if window_ms % slide_ms:
            raise ValueError("the window must be a multiple of the slide")
        self.window_ms, self.slide_ms = window_ms, slide_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "start long", "known array<double>, counts array<long>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found: dict[int, Counter] = defaultdict(Counter)
        for r in rows:
            found[r["pane"]][r["value"]] += r["n"]
        for start, counts in found.items():
            if self.panes.containsKey((start,)):
                known, n = self.panes.getValue((start,))
                counts.update(dict(zip(known, n)))
            self.panes.updateValue((start,), (list(counts.keys()), list(counts.values())))
            for end in range(start + self.slide_ms, start + self.window_ms + 1, self.slide_ms):
                self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        held: Counter = Counter()
        for start in range(end - self.window_ms, end, self.slide_ms):
            if self.panes.containsKey((start,)):
                known, n = self.panes.getValue((start,))
                held.update(dict(zip(known, n)))
        first = end - self.window_ms
        if self.panes.containsKey((first,)):
            self.panes.removeKey((first,))
        if held:
            yield row_of(WINDOW_SCHEMA)(*key, first, end, *window_values(held))

    def close(self) -> None:
        pass


def window_values(held: Counter) -> tuple:
    """count, mean, median, std, min, max, range and anomalies of values with counts."""
    values = sorted(held)
    counts = [held[v] for v in values]
    total = sum(counts)
    mean = math.fsum(v * n for v, n in zip(values, counts)) / total
    squares = math.fsum(n * (v - mean) ** 2 for v, n in zip(values, counts))
    std = math.sqrt(squares / (total - 1)) if total > 1 else 0.0
    upto = list(accumulate(counts))
    low, high = (values[bisect_right(upto, at)] for at in ((total - 1) // 2, total // 2))
    apart = [v for v, n in zip(values, counts) if std > 0 and abs(v - mean) > 3 * std for _ in range(n)]
    return total, mean, (low + high) / 2, std, values[0], values[-1], values[-1] - values[0], apart


def sliding_windows(panes: DataFrame, window_ms: int, slide_ms: int) -> DataFrame:
    """Closed windows of a stream of panes: equipment_id, sensor, pane (its start in ms), value and n (its count)."""
    panes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return panes.groupBy("equipment_id", "sensor").transformWithState(
        PaneWindows(window_ms, slide_ms), outputStructType=WINDOW_SCHEMA, outputMode="append", timeMode="EventTime"
    )


class HeldReadings(StatefulProcessor):
    """Readings of one series and time slot while the watermark is within ``window_ms`` of them.

    Emits a reading as ``kept`` when it arrives, as ``late`` instead if the watermark is already past its time, and as
    ``evicted`` when the watermark passes it. At most ``CHUNK`` arriving readings, and when the watermark stands inside a slot
    the rest of that slot, are held in Python.
    """

    def __init__(self, window_ms: int):
        self.window_us = window_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "event_us long, value double")

    def _wait_for(self, event_us: int) -> None:
        self.handle.registerTimer(-(-(event_us + self.window_us) // 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh, first = [], None
        for r in rows:
            late = r["event_us"] + self.window_us <= passed
            if not late:
                fresh.append((r["event_us"], r["value"]))
                first = r["event_us"] if first is None else min(first, r["event_us"])
            if len(fresh) == CHUNK:
                self.held.appendList(fresh)
                fresh = []
            yield HELD_ROW(*key[:2], r["event_us"], r["value"], "late" if late else "kept")
        if fresh:
            self.held.appendList(fresh)
        if first is not None:
            self._wait_for(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rest = []
        for event_us, value in self.held.get():
            if event_us + self.window_us <= passed:
                yield HELD_ROW(*key[:2], event_us, value, "evicted")
            else:
                rest.append((event_us, value))
        if rest:
            self.held.put(rest)
            self._wait_for(min(r[0] for r in rest))
        else:
            self.held.clear()

    def close(self) -> None:
        pass


def held_readings(series: DataFrame, window_ms: int = 60_000, delay: str = "0 seconds") -> DataFrame:
    """Every reading of a stream as ``kept`` or ``late``, and again as ``evicted`` once the watermark has left it behind.

    ``series``: equipment_id, sensor, value, event_time. The watermark is kept off the rows that reach the state, so that
    Spark does not drop late ones before they are seen. A reading's status depends on its own time alone, so a series is
    dealt over tasks by slots of a ``SLOTS``-th of the window.
    """
    series.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = series.withWatermark("event_time", delay).withColumn("event_us", F.unix_micros("event_time"))
    slot = F.floor(F.col("event_us") / F.lit(window_ms * 1000 / SLOTS)).alias("slot")
    out = timed.select("equipment_id", "sensor", "value", "event_us", slot).groupBy("equipment_id", "sensor", "slot").transformWithState(
        HeldReadings(window_ms),
        outputStructType=HELD_SCHEMA,
        outputMode="append",
        timeMode="EventTime",
    )
    return out.select("equipment_id", "sensor", F.timestamp_micros("event_us").alias("event_time"), "value", "status")


class ReadingHistory(StatefulProcessor):
    """Last readings per key; emits the 3-point mean and the change over the history once three are known.

    Readings wait until the watermark has passed them and are then taken in event-time order, so the result does not
    depend on the micro-batches they came in.
    """

    def __init__(self, columns: Sequence[str], depth: int = HISTORY_DEPTH, minimum: int = 3):
        self.columns, self.depth, self.minimum = list(columns), depth, minimum

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField(c, T.DoubleType()) for c in self.columns]
        self.handle = handle
        self.history = handle.getListState("history", T.StructType(fields))
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("event_us", T.LongType()), *fields]))

    def _wait_for(self, event_us: int) -> None:
        self.handle.registerTimer(-(-event_us // 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = [(r["event_us"], *[r[c] for c in self.columns]) for r in rows]
        self.waiting.appendList(fresh)
        self._wait_for(min(r[0] for r in fresh))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest = [], []
        for r in self.waiting.get():
            (due if r[0] <= passed else rest).append(tuple(r))
        if rest:
            self.waiting.put(rest)
            self._wait_for(min(rest, key=lambda r: r[0])[0])
        else:
            self.waiting.clear()
        if not due:
            return
        known = [tuple(r) for r in self.history.get()] if self.history.exists() else []
        due.sort(key=lambda r: (r[0], [(v is not None, v or 0.0) for v in r[1:]]))
        for event_us, *values in due:
            known = [*known, tuple(values)][-self.depth :]
            out = [key[0], event_us]
            for i in range(len(self.columns)):
                series = [k[i] for k in known]
                ready = len(series) >= self.minimum
                mean = sum(series[-3:]) / 3 if len(series) >= 3 and None not in series[-3:] else None
                change = series[-1] - series[0] if ready and None not in (series[-1], series[0]) else None
                out += [series[-1], mean, change]
            yield row_of(history_schema(self.columns))(*out)
        self.history.put(known)

    def close(self) -> None:
        pass


def history_schema(columns: Sequence[str]) -> str:
    parts = ["equipment_id string", "event_us long"]
    for c in columns:
        parts += [f"{c} double", f"{c}_rolling_mean_3 double", f"{c}_trend double"]
    return ", ".join(parts)


def with_history(rows: DataFrame, columns: Sequence[str], delay: str = "60 seconds") -> DataFrame:
    """Stateful enrichment in event-time order; a row is emitted once the watermark has passed it, later rows are dropped."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = rows.withWatermark("event_time", delay).select("equipment_id", "event_time", F.unix_micros("event_time").alias("event_us"), *columns)
    out = timed.groupBy("equipment_id").transformWithState(
        ReadingHistory(columns), outputStructType=history_schema(columns), outputMode="append", timeMode="EventTime"
    )
    return out.withColumnRenamed("event_us", "event_time").withColumn("event_time", F.timestamp_micros("event_time"))


class ScoreCache(StatefulProcessor):
    """A probability for every row, computed once per key and time-to-live."""

    def __init__(self, predict: Callable[[Sequence[float]], float], features: Sequence[str], ttl_ms: int | None):
        self.predict, self.features, self.ttl_ms = predict, list(features), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "probability double", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get()[0] if self.last.exists() else None
        for r in rows:
            hit = known is not None
            if not hit:
                known = self.predict([r[f] for f in self.features])
                self.last.update((known,))
            yield row_of(CACHED_SCHEMA)(r["request_id"], known, hit)

    def close(self) -> None:
        pass


def cached_scores(
    requests: DataFrame, predict: Callable[[Sequence[float]], float], features: Sequence[str], ttl_ms: int | None = SCORE_TTL_MS
) -> DataFrame:
    """request_id, failure_probability and cached (whether an equal request was scored within the time-to-live)."""
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return requests.select("request_id", *features).groupBy(*features).transformWithState(
        ScoreCache(predict, features, ttl_ms),
        outputStructType=CACHED_SCHEMA,
        outputMode="append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


class LatestFeatures(StatefulProcessor):
    """Newest values per key by event time, forgotten after the time-to-live; emits every replacement."""

    def __init__(self, columns: Sequence[str], ttl_ms: int | None = ONLINE_TTL_MS):
        self.columns, self.ttl_ms = list(columns), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField("event_time", T.TimestampType())]
        fields += [T.StructField(c, T.DoubleType()) for c in self.columns]
        self.latest = handle.getValueState("latest", T.StructType(fields), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for chunk in rows:
            candidate = chunk.loc[chunk["event_time"].idxmax()]
            if best is None or candidate["event_time"] > best["event_time"]:
                best = candidate
        stored = self.latest.get() if self.latest.exists() else None
        if best is None or (stored is not None and pd.Timestamp(stored[0]) >= best["event_time"]):
            return
        values = tuple(None if pd.isna(best[c]) else float(best[c]) for c in self.columns)
        self.latest.update((best["event_time"].to_pydatetime(), *values))
        yield pd.DataFrame([(key[0], best["event_time"], *values)], columns=["equipment_id", "event_time", *self.columns])

    def close(self) -> None:
        pass


def latest_features(rows: DataFrame, columns: Sequence[str], ttl_ms: int | None = ONLINE_TTL_MS) -> DataFrame:
    """Stateful online store. With a time-to-live Spark keeps scheduling batches to expire state, so run such a
    query with a processing-time trigger; ``ttl_ms=None`` keeps state for good and suits ``availableNow``.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = "equipment_id string, event_time timestamp, " + ", ".join(f"{c} double" for c in columns)
    return (
        rows.select("equipment_id", "event_time", *columns)
        .groupBy("equipment_id")
        .transformWithStateInPandas(
            LatestFeatures(columns, ttl_ms),
            outputStructType=schema,
            outputMode="update",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
    )
