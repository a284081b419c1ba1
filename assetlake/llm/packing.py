"""Best-fit packing of token sequences by exact complements.

Documents become pieces of at most ``capacity`` tokens; only the counts of piece lengths (``capacity`` numbers) reach
the driver. There ``plan`` fills sequences: for each length, longest first, it looks up which single length, pair or
triple of lengths fills the gap exactly, and takes the combination as often as the counts allow; what has no exact
complement is packed best-fit, longest first, also by counts. A plan is a list of runs (lengths of a sequence, how many
such sequences). Pieces of one length are numbered in many tasks (numbers within chunks plus the chunks' offsets) and
find their sequence by that number, so a length that a third of all pieces share is not one task's work.

Null and empty texts are one piece of the end id alone. Rows that share a doc_id are packed each on its own.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts, pieces, release_powers
from assetlake.llm.storage import written
from assetlake.llm.tokens import check_words, default_path, opened
from assetlake.session import shuffle_partitions

CAPACITY, END_ID = 2048, 0
BATCH_BYTES = 4 << 20  # text encoded at once: words that come again are looked up once
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk int"
Run = tuple[tuple[int, ...], int]


def _exact(counts: list[int], capacity: int) -> list[Run]:
    """Runs that fill a sequence exactly; counts are lowered by what they use."""
    runs: list[Run] = []

    def take(lengths: tuple[int, ...]) -> bool:
        use = {x: lengths.count(x) for x in lengths}
        times = min(counts[x] // n for x, n in use.items())
        if times < 1:
            return False
        for x, n in use.items():
            counts[x] -= times * n
        runs.append((lengths, times))
        return True

    sums: dict[int, list[tuple[int, int]]] = {}  # pair sums, an index made when first needed

    def pairs(total: int) -> list[tuple[int, int]]:
        if total not in sums:
            sums[total] = [(a, total - a) for a in range(total - 1, (total - 1) // 2, -1) if a >= total - a and counts[a] and counts[total - a]]
        return sums[total]

    for length in range(capacity, 0, -1):
        gap = capacity - length
        if counts[length] and gap == 0:
            take((length,))
            continue
        if counts[length] and gap <= capacity:
            take((length, gap))
        for pair in pairs(gap) if counts[length] else ():
            take((length, *pair))
            if not counts[length]:
                break
        if counts[length]:
            for third in range(gap - 2, 0, -1):
                if not counts[third]:
                    continue
                for pair in pairs(gap - third):
                    if pair[0] <= third:
                        take((length, third, *pair))
                        if not counts[length] or not counts[third]:
                            break
                if not counts[length]:
                    break
    return runs


def _best_fit(counts: list[int], capacity: int) -> list[Run]:
    """Best-fit decreasing over counts: bins are kept as runs with the same content."""
    open_bins: dict[int, list[list]] = {}  # gap: runs [lengths, times]
    gaps: list[int] = []
    done: list[Run] = []

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = capacity - sum(lengths)
        if gap == 0:
            done.append((lengths, times))
            return
        if gap not in open_bins:
            open_bins[gap] = []
            gaps.insert(bisect_left(gaps, gap), gap)
        open_bins[gap].append([lengths, times])

    for length in range(capacity, 0, -1):
        left = counts[length]
        counts[length] = 0
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                if left >= fit:
                    put((length,) * fit, left // fit)
                if left % fit:
                    put((length,) * (left % fit), 1)
                break
            gap = gaps[at]
            run = open_bins[gap][-1]
            fit = min(gap // length, left)
            times = min(run[1], left // fit)
            run[1] -= times
            lengths = run[0]
            if not run[1]:
                open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap]
                    gaps.pop(at)
            left -= times * fit
            put(lengths + (length,) * fit, times)
    return done + [(lengths, times) for runs in open_bins.values() for lengths, times in runs]


def plan(counts: list[int], capacity: int = CAPACITY) -> list[Run]:
    """Sequences for ``counts[length]`` pieces of every length from 1 to ``capacity``."""
    left = list(counts)
    return _exact(left, capacity) + _best_fit(left, capacity)


def slots(runs: list[Run]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs' places in order: first number, first sequence, offset, and how many share a sequence."""
    used: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, times in runs:
        offset = 0
        for length in lengths:
            number = used.get(length, 0)
            out.setdefault(length, []).append((number, sequence, offset))
            used[length] = number + times
            offset += length
        sequence += times
    return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text): piece, start, length and the CRC-32 of its ids."""
    check_words(path)
    chunks = max(1, shuffle_partitions(docs.sparkSession))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_powers()  # deduplication before it leaves them
        encoder, made = opened(path), 0
        for batch in batches:
            ids, values = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for lo, hi in pieces(values, BATCH_BYTES):
                rows = []
                for doc_id, found in zip(ids[lo:hi], encoder.encode(values[lo:hi])):
                    found += end
                    for piece, at in enumerate(range(0, len(found), 4 * capacity)):
                        part = found[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), made % chunks))
                        made += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], [f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Place of every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    parts = written(cut(docs, path or default_path(), capacity, end_id), "pieces")
    counts = [0] * (capacity + 1)
    for length, n in parts.groupBy("length").agg(F.count("*")).collect():  # at most ``capacity`` rows
        counts[length] = n
    place = spark.sparkContext.broadcast(slots(plan(counts, capacity)))  # runs are bounded by the lengths, not the pieces
    per_chunk = parts.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = per_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = parts.withColumn("inner", inner).join(base, ["length", "chunk"]).withColumn("number", F.col("base") + F.col("inner"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = (batch.column(n).to_numpy() for n in ("length", "number"))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                first, start, at = place.value[length]
                slot = np.searchsorted(first, numbers[rows], side="right") - 1
                sequence[rows], offset[rows] = start[slot] + numbers[rows] - first[slot], at[slot]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(run, schema)
