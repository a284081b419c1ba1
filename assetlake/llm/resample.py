"""Target-distribution importance resampling: documents drawn by how much more likely the target makes their features.

A feature is a run of 1 to ``order`` consecutive words joined by one space, repeats counted; it falls into the bucket
crc32 modulo ``buckets``. A batch's texts are joined with sentinels, one regular expression finds all words, document
offsets tell which runs cross documents, and ``bincount`` adds up what is left. With s of S corpus features and t of T
target features in a bucket its gain is floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))).
A document's weight is the sum of its features' gains; its score adds Gumbel noise from a digest of its id.

Drawn are the ``percent`` of the documents with ``least_words`` words or more that score highest, by a range sort;
ranks are the rows' places in their range plus the sizes of the ranges before.

Null and empty texts have no feature and weight 0. Each row is a document, rows that share a doc_id too; ties go to the
smaller doc_id (null first), then in any order among equal rows. A null doc_id is digested as the empty string. Without
target texts all gains come from T = 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts, pieces
from assetlake.llm.storage import written
from assetlake.llm.terms import batch_terms
from assetlake.session import shuffle_partitions

BUCKETS, ORDER, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
KEPT_WORDS = 200_000  # words whose sums a task keeps; then it begins anew
SCORED = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


class Features:
    """Buckets of the features of batches of texts."""

    def __init__(self, buckets: int, order: int):
        self.buckets, self.order = buckets, order
        self.known: dict[bytes, int] = {}

    def of(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bucket and the text of every feature, and the texts' numbers of words."""
        words, owner = batch_terms(values)
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known = self.known
        for word in set(words).difference(known):
            known[word] = crc32(word)
        sums = [known[w] for w in words]
        number, text = [np.array(sums, np.int64)], [owner]
        for k in range(1, self.order):
            sums = [crc32(b" " + w, s) for w, s in zip(words[k:], sums)]  # the run so far, one word longer
            inside = owner[k:] == owner[: len(owner) - k]
            number.append(np.array(sums, np.int64)[inside])
            text.append(owner[k:][inside])
        return np.concatenate(number) % self.buckets, np.concatenate(text), np.bincount(owner, minlength=len(values))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """bucket, n: features of all texts of ``docs`` by bucket; a task gives at most one row for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, order), np.zeros(buckets, np.int64)
        for batch in batches:
            values = byte_texts(batch.column(0))
            for lo, hi in pieces(values):
                total += np.bincount(features.of(values[lo:hi])[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket; the driver reads one row for each bucket of corpus and target counts (bucket, n)."""
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (corpus, target))
    more, least = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return np.array([math.floor(1000 * math.log((t.get(b, 0) + 1) * more / ((s.get(b, 0) + 1) * least))) for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths from the first 32 bits of a digest."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain), order)
        for batch in batches:
            values, ids = byte_texts(batch.column(1)), batch.column(0).to_pylist()
            columns: list[list[np.ndarray]] = [[], [], []]
            for lo, hi in pieces(values):
                bucket, text, n_words = features.of(values[lo:hi])
                weight = np.bincount(text, weights=gain[bucket], minlength=hi - lo)  # whole numbers far below 2**53
                for column, part in zip(columns, (n_words, np.bincount(text, minlength=hi - lo), weight)):
                    column.append(part.astype(np.int64))
            if not ids:
                continue
            n_words, n_features, weight = (np.concatenate(c) for c in columns)
            total = weight + np.array([noise(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in (n_words, n_features, weight, total))], ["doc_id", "n_words", "n_features", "weight", "score"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(score, SCORED)


def ranked(rows: DataFrame, order: list, n: int, rank: str = "rank") -> DataFrame:
    """``rows`` with their place in ``order`` from 1 where it is ``n`` or less, else null.

    Rows are cut into ranges and sorted inside them; only the ranges' sizes meet (one row for each partition).
    """
    parts = shuffle_partitions(rows.sparkSession)
    placed = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    sizes = sorted(map(tuple, placed.groupBy("_range").agg(F.count("*")).collect()))  # at most ``parts`` rows
    before, firsts = 0, []
    for part, size in sizes:
        firsts.append((part, before))
        before += size
    first = rows.sparkSession.createDataFrame(firsts, "_range bigint, _first bigint")
    place = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(first), "_range").withColumn(rank, F.when(place <= n, place)).drop("_at", "_range", "_first")


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, order: int = ORDER, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of ``docs`` (doc_id, text)."""
    gain = gains(bucket_counts(docs, buckets, order), bucket_counts(target, buckets, order), buckets)
    rows = written(scored(docs, gain, order, seed).withColumn("row", F.monotonically_increasing_id()), "resample-scores")
    asked = rows.filter(F.col("n_words") >= least_words)
    drawn = percent * asked.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    places = ranked(asked, [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row")], drawn)
    others = rows.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return places.select(*columns, "rank").unionByName(others)
