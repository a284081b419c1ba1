"""SimHash near-duplicates by multi-index hashing.

Fingerprint: A-Z lower-cased, words, three-word shingles with repeats (fewer words: the whole sequence; none: zero);
a bit is 1 if it is set in more than half of the shingles' XXH64 values (seed 42).

Search: documents are first reduced to distinct fingerprints. A fingerprint is cut into two halves of 32 bits; two
fingerprints at distance 3 or less agree in one half up to one bit. Each half's table is probed with the ball of
radius 1 (33 values), matches are verified over all 64 bits. A table entry with more than ``CROWD`` members is not
expanded into pairs: there members and probes meet at the codes of the balls around their other halves, which gives the
same connected classes with work in proportion to the members (see ``_crowd_links``).

Null and empty texts have fingerprint zero. Rows that share a doc_id are kept; a null doc_id gets the smallest known id
of its class, or null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts
from assetlake.llm.components import connected
from assetlake.llm.storage import written

SHINGLE, SEED, REACH = 3, 42, 3
CROWD = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HALF = (1 << 32) - 1


def fingerprint(text: bytes) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) > SHINGLE:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    else:
        shingles = [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([fingerprint(t) for t in byte_texts(batch.column(1))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "fp"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id bigint, fp bigint"
    )


def _half(fp: Column, side: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if side == 0 else fp.bitwiseAND(F.lit(_HALF))


def _flips(count: int) -> list[int]:
    """Differences of ``count`` bits or fewer in 32."""
    out = [0] + [1 << i for i in range(32)]
    if count > 1:
        out += [(1 << i) | (1 << j) for i in range(32) for j in range(i)]
    return out


def _ball(value: Column, count: int) -> Column:
    """All codes within ``count`` bits."""
    return F.explode(F.transform(F.lit(_flips(count)).cast("array<bigint>"), lambda f: f.bitwiseXOR(value)))


def _crowd_links(members: DataFrame, probes: DataFrame) -> DataFrame:
    """Links of probes and members of crowded entries, through codes of the other half.

    Members (m) are at every code within 1 bit of their other half. A probe that agrees with the entry is at every code
    within 2 bits, one that differs by a bit at every code within 1. Whatever meets at a code with a member is in the
    member's class: two members differ by 2 bits at most, the probes by 3 at most; every pair at distance 3 or less meets.
    """
    at = ["side", "value", "code"]
    own = members.select("side", "value", "other", "fp").withColumn("code", _ball(F.col("other"), 1))
    leader = own.groupBy(*at).agg(F.min("fp").alias("leader"))
    near = probes.filter("flip != 0").withColumn("code", _ball(F.col("other"), 1))
    same = probes.filter("flip = 0").withColumn("code", _ball(F.col("other"), 2))
    guests = near.unionByName(same).select(*at, "fp")
    return guests.join(leader.hint("merge"), at).filter("fp != leader").select(F.col("fp").alias("a"), F.col("leader").alias("b"))


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) whose connected classes are those of all pairs of distinct fingerprints at distance 3 or less."""
    entry = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), _half(F.col("fp"), s).alias("value"), _half(F.col("fp"), 1 - s).alias("other")) for s in (0, 1)]))
    entries = fps.select("fp", entry.alias("e")).select("fp", "e.*")
    crowded = entries.groupBy("side", "value").agg(F.count("*").alias("size"))
    sized = written(entries.join(crowded, ["side", "value"]), "simhash-tables")
    probes = entries.withColumn("flip", F.explode(F.lit(_flips(1)).cast("array<bigint>")))
    probes = probes.withColumn("value", F.col("value").bitwiseXOR(F.col("flip")))
    small = sized.filter(F.col("size") <= CROWD).select("side", "value", F.col("fp").alias("b"))
    pairs = (
        probes.select("side", "value", F.col("fp").alias("a"))
        .join(small.hint("merge"), ["side", "value"])  # the planner takes exploded rows for few
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= REACH))
        .select("a", "b")
    )
    big = sized.filter(F.col("size") > CROWD)
    if big.isEmpty():
        return pairs
    names = big.select("side", "value").distinct()
    return pairs.unionByName(_crowd_links(big, probes.join(names.hint("merge"), ["side", "value"])))


def components(fps: DataFrame) -> DataFrame:
    """Class of every fingerprint that has a link: fp, label (the least fingerprint of the class)."""
    edges = written(links(fps).distinct(), "simhash-links")
    return connected(edges)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs`` (doc_id, text)."""
    prints = written(with_fingerprints(docs), "simhash-prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    labels = components(distinct.select("fp"))
    known = distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    names = known.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = known.join(names, "label").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
