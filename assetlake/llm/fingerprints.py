"""Document fingerprints of content-defined chunks.

A gear hash over the last 16 bytes sets chunk borders. Sizes are normalised: up to ``NORMAL`` bytes a border needs more
zero bits than beyond it; no chunk is shorter than ``LEAST`` or longer than ``MOST``. The fingerprint is the set of
chunk digests with their lengths, ``digest:length`` joined by commas in order of digest, so it does not depend on where
a chunk stands. Likeness of two fingerprints is the containment of the lighter in the heavier one: the weight
(chunk lengths) of the common digests over the lighter total. Empty and null texts have the empty fingerprint; its
likeness to another empty one is 1, to any other 0.

The next document is the next row in ascending doc_id (null ids first; equal ids in order of text); after the last row
comes the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.storage import written
from assetlake.session import shuffle_partitions

LEAST, NORMAL, MOST = 8, 32, 128
_GEAR = np.random.default_rng(20250101).integers(0, 1 << 32, 256, dtype=np.uint32)
_STRICT, _LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)  # 6 bits before the normal size, 4 after it
DIGITS = 10  # hexadecimal digits of a chunk's digest


def borders(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for shift in (1, 2, 4, 8):
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift)) if n > shift else h[shift:]
    loose = np.flatnonzero((h & _LOOSE) == 0)
    strict = ((h[loose] & _STRICT) == 0).tolist()
    places = (loose + 1).tolist()
    out, start, i, count = [], 0, 0, len(places)
    while n - start > LEAST:
        low, normal, high = start + LEAST, start + NORMAL, min(start + MOST, n)
        while i < count and places[i] < low:
            i += 1
        j, end = i, high
        while j < count and places[j] <= high:
            if strict[j] or places[j] > normal:
                end = places[j]
                break
            j += 1
        out.append(end)
        start, i = end, j
    if start < n:
        out.append(n)
    return out


def chunk_weights(data: bytes) -> dict[str, int]:
    """Digest of every distinct chunk with its length."""
    out, start, digest = {}, 0, xxhash.xxh64_hexdigest
    for end in borders(data) if data else ():
        out[digest(data[start:end])[:DIGITS]] = end - start
        start = end
    return out


def printed(weights: dict[str, int]) -> str:
    return ",".join([f"{k}:{v}" for k, v in sorted(weights.items())])


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    shared = sum([a[k] for k in a.keys() & b.keys()])
    return shared / min(sum(a.values()), sum(b.values()))


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, order); the row that ends a cell is a guest, the first row of the next cell."""
    held: tuple | None = None
    for batch in batches:
        out: list[tuple] = []
        for cell, guest, doc_id, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            weights = chunk_weights(text.encode("utf-8", "surrogatepass"))
            if held is not None and held[0] == cell:
                _, before, own, own_weights = held
                cut = len(own) // 2
                edited = (own[: len(own) - cut] + text[:cut]).encode("utf-8", "surrogatepass")
                changed = chunk_weights(edited)
                out.append((before, len(own), hashlib.sha256(edited).hexdigest(), printed(own_weights), printed(changed), likeness(own_weights, changed), likeness(own_weights, weights)))
            held = None if guest else (cell, doc_id, text, weights)
        if out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of their edited texts, with their likeness.

    Rows are cut into ranges of doc_id (cuts from a quantile sketch); each range also gets the first row of the next
    one, so texts are shuffled once. The driver sees one id for each range.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    wanted = max(1, shuffle_partitions(spark))
    ids = base.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"))
    cuts = ids.agg(F.percentile_approx("id", [i / wanted for i in range(1, wanted)] or [0.5], 20 * wanted + 1000)).first()[0] or []
    cuts = sorted(set(cuts))[: wanted - 1] if wanted > 1 else []
    cell = F.lit(0)
    array = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    step, at = 1 << max(0, len(cuts).bit_length()), F.lit(0)
    steps = []
    while step:
        steps.append(step)
        step //= 2
    if cuts:
        cell = F.aggregate(
            F.lit(steps).cast("array<int>"), at,
            lambda have, s: F.when((have + s <= len(cuts)) & (F.get(array, have + s - 1) <= F.col("id")), have + s).otherwise(have),
        )
    placed = base.withColumn("id", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("cell", cell)
    first = {r["cell"]: r["id"] for r in placed.groupBy("cell").agg(F.min("id").alias("id")).collect()}
    order = sorted(first)
    heads = [(first[c], order[i - 1]) for i, c in enumerate(order)]  # the first cell's head follows the last cell
    if heads:
        head = F.create_map(*[F.lit(x).cast("bigint") if k % 2 == 0 else F.lit(x).cast("int") for pair in heads for k, x in enumerate(pair)])
        to = F.try_element_at(head, F.col("id"))
    else:
        to = F.lit(None).cast("int")
    copies = F.explode(F.filter(F.array(F.struct(F.col("cell").alias("cell"), F.lit(False).alias("guest")), F.when(to.isNotNull(), F.struct(to.alias("cell"), F.lit(True).alias("guest")))), lambda c: c.isNotNull()))
    dealt = placed.select("doc_id", "id", "text", copies.alias("c")).select("c.cell", "c.guest", "doc_id", "text", "id")
    ordered = dealt.repartition(max(1, len(order)), "cell").sortWithinPartitions("cell", "guest", "id", "text")
    return ordered.select("cell", "guest", "doc_id", "text").mapInArrow(_fingerprints, SCHEMA)
