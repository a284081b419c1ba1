"""Ranked lexical search: the best documents for every item, by dense blocked matrix products.

A term's weight is w = floor(1000 * ln((2N + 2) / (2df + 1))); a document with tf occurrences has the impact
(10**9 * tf) div (1000 * tf + 20 * m), with m = 50 + (50 * n * N) div L. N documents hold a term, L terms in all, the
document n; a score is the sum of w * impact over the item's distinct terms.

Items are searched in blocks of bounded text. One pass over the documents writes, for each document, its number of terms
and the counts of the block's terms; df, N and L come from that table. Then items are cut into tiles, each with its own
compact vocabulary, and documents into tiles of impacts; a float64 product of the two gives a tile of scores. Weights and
impacts are whole numbers; vocabulary tiles are cut so that no partial sum reaches 2**53, and partial sums are added as
64-bit integers, so scores are exact. A task keeps the k best of its documents for every item; equal scores are cut by
doc_id, so a cut never loses a row of the result. The tasks' rows are cut in two steps, by (item, part) and by item.

Null and empty texts have no term. Each row is a document, rows that share a doc_id too; null doc_ids are smaller than
any other. Items that share an item_id are one item; a null item_id is an item. Items without a term have no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts
from assetlake.llm.storage import written
from assetlake.llm.terms import terms

BEST = 50
BLOCK_BYTES = 1 << 20  # item text whose vocabulary and tiles (about 50 times as many bytes) every task holds at once
ITEM_TILE, DOC_TILE = 32, 1024
IMPACT_BOUND = 10**6  # an impact is below it, as m is positive
EXACT = 2**53
PARTS = 64  # groups in which the tasks' best rows are cut first
FOUND = "n bigint, doc_id bigint, term array<int>, tf array<int>"


class Block:
    """Items (item_id, their distinct terms) with a vocabulary of their own."""

    def __init__(self, items: dict[int | None, set[bytes]]):
        self.ids = sorted(items, key=lambda i: (i is not None, i or 0))
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*items.values())))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in items[i]), np.int64) for i in self.ids]

    def tiles(self, weight: np.ndarray, size: int, exact: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First item, vocabulary and dense weights (items x vocabulary) of every tile."""
        for first in range(0, len(self.ids), size):
            own = self.terms[first : first + size]
            used = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
            width = max(1, min(len(used), exact // (IMPACT_BOUND * max(1, int(weight.max(initial=1))))))
            for lo in range(0, len(used), width):
                part = used[lo : lo + width]
                dense = np.zeros((len(own), len(part)))
                for row, t in enumerate(own):
                    here = t[np.isin(t, part)]
                    dense[row, np.searchsorted(part, here)] = weight[here]
                yield first, part, dense


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of items (item_id, text); the driver holds one at a time."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    dealt = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for k in range(count):
        found: dict[int | None, set[bytes]] = {}
        for r in dealt.filter(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).toLocalIterator():
            found.setdefault(r["item_id"], set()).update(terms(bytes(r["text"] or b"")))
        if any(found.values()):
            yield Block({i: t for i, t in found.items() if t})


def counted(docs: DataFrame, block: Block) -> DataFrame:
    """n (terms with repeats) and the counts of the block's terms, for every document with a term."""
    vocabulary = block.vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, term, tf, ends = [], [], [], [], [0]
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                held = Counter(terms(text))
                if not held:
                    continue
                n.append(held.total())
                ids.append(doc_id)
                for t in vocabulary.keys() & held.keys():
                    term.append(vocabulary[t])
                    tf.append(held[t])
                ends.append(len(term))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (term, tf)]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.int64()), *lists], ["n", "doc_id", "term", "tf"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(count, FOUND)


def best_places(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0; equal ones by id, null first."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]  # with all ties of the last one
    order = np.lexsort((ids[at], ~nulls[at], -scores[at]))
    return at[order[:k]]


def _best(held: DataFrame, block: Block, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The k best documents of every task for every item of the block."""
    items = block.ids

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = list(block.tiles(weight, ITEM_TILE, EXACT))
        top: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(items)
        for whole in batches:
            for start in range(0, whole.num_rows, DOC_TILE):
                batch = whole.slice(start, DOC_TILE)
                ids = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
                nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
                term, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                sizes = batch.column(2).value_lengths().to_numpy()
                doc = np.repeat(np.arange(batch.num_rows), sizes)
                m = 50 + (50 * batch.column(0).to_numpy() * n_docs) // n_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                scores = np.zeros((len(items), batch.num_rows), np.int64)
                place = np.full(len(weight), -1, np.int64)
                for first, vocabulary, dense in tiles:
                    place[vocabulary] = np.arange(len(vocabulary))
                    column = place[term]
                    use = column >= 0
                    impacts = np.zeros((len(vocabulary), batch.num_rows))
                    impacts[column[use], doc[use]] = impact[use]
                    scores[first : first + len(dense)] += (dense @ impacts).astype(np.int64)
                    place[vocabulary] = -1
                for i, row in enumerate(scores):
                    here = best_places(row, ids, nulls, k)
                    if len(here) and (len(top[i][0]) < k or row[here[0]] >= top[i][0][-1]):
                        both = [np.concatenate(pair) for pair in zip(top[i], (row[here], ids[here], nulls[here]))]
                        kept = best_places(*both, k)
                        top[i] = tuple(c[kept] for c in both)
        for item, (score, ids, nulls) in zip(items, top):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(score), pa.int64()), pa.array(ids, pa.int64(), mask=nulls), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"]
            )

    return held.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents (doc_id, text) of every item (item_id, text)."""
    spark = docs.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in blocks(items, block_bytes):
        held = written(counted(docs, block), "search-counts")
        n_docs, n_terms = held.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(block.vocabulary), np.int64)
        for r in held.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator():  # one row a term of the block
            df[r["term"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        best = _best(held, block, weight, n_docs, n_terms, k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        some = Window.partitionBy("item_id", "part").orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k).drop("rank", "part")
        whole = best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
        out = out.unionByName(written(whole.select("item_id", "rank", "doc_id", "score"), "search-best"))
    return out
