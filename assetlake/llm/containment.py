"""Which short items (templates, test items) do documents contain? MinHash over text windows, DataFrame functions only.

Texts are lower-cased and cut into words at white space (0x20, 0x09 to 0x0D); a shingle is five words joined by spaces.
Shingles that no item has cannot make an item's minimum, so a join with the items' shingles leaves them out before
anything is sketched; what remains of a document is little, and a window's sketch is not diluted by other text.

``retrieve`` gives candidates: overlapping windows of shingle positions, a MinHash signature of each window and of
each item, and a candidate wherever one band is equal. ``verified`` counts the shared distinct shingles exactly.

Null and empty texts and texts under five words contain nothing. Rows that share a doc_id are one document. Items under
five words have no shingle and match nothing; items that share an id are one item.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.storage import written

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_SHINGLES = 500_000  # item shingles (about 50 bytes each) that every task may hold; more are joined by shuffle


def bands_for(similarity: float, rows: int = 1, miss: float = 1e-6) -> int:
    """Bands of ``rows`` values so that a pair of this Jaccard similarity has no equal band with probability ``miss`` at most."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(similarity**rows, 1 - 1e-12))))


def _shingles_of(df: DataFrame, key: str) -> DataFrame:
    """key, place, shingle: one row for each shingle of a text."""
    plain = F.translate(F.lower(F.col("text")), "\t\n\x0b\f\r", "     ")
    words = df.select(F.col(key), F.array_remove(F.split(plain, " "), "").alias("words")).filter(F.size("words") >= SHINGLE)
    rows = F.transform(
        F.sequence(F.lit(0), F.size("words") - SHINGLE),
        lambda i: F.concat_ws(" ", *[F.get(F.col("words"), i + k) for k in range(SHINGLE)]),
    )
    return words.select(key, F.posexplode(rows).alias("place", "shingle"))


def item_shingles(items: DataFrame) -> DataFrame:
    """Distinct shingles of items (item_id, text) and each item's number of them, written once."""
    one = _shingles_of(items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).filter("item_id is not null"), "item_id")
    one = one.select("item_id", "shingle").distinct()
    sizes = one.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return written(one.join(sizes, "item_id"), "item-shingles")


def hits(docs: DataFrame, shingled: DataFrame) -> DataFrame:
    """doc_id, place, shingle of the document shingles that some item has, written once."""
    vocabulary = shingled.select("shingle").distinct()
    if shingled.count() <= BROADCAST_SHINGLES:
        vocabulary = F.broadcast(vocabulary)
    own = _shingles_of(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter("doc_id is not null"), "doc_id")
    return written(own.join(vocabulary, "shingle", "left_semi").select("doc_id", "place", "shingle"), "shingle-hits")


def _signature(bands: int, rows: int) -> list[Column]:
    """Minima of ``bands * rows`` hash functions, named m0, m1, ..."""
    return [F.min(F.xxhash64("h", F.lit(k))).alias(f"m{k}") for k in range(bands * rows)]


def _band_keys(bands: int, rows: int) -> Column:
    keys = [F.xxhash64(F.lit(b), *[F.col(f"m{b * rows + r}") for r in range(rows)]) for b in range(bands)]
    return F.explode(F.array(*keys))


def retrieve(found: DataFrame, shingled: DataFrame, classes: Sequence[tuple[int, int]], bands: int, rows: int = 1) -> DataFrame:
    """Candidates (doc_id, item_id).

    ``classes`` are size ranges (least, most) of items in shingles; a class has windows of twice its most shingles,
    which begin at every multiple of it, so that an item that stands together lies whole in one of them.
    """
    number = F.lit(-1)
    for least, most in classes:
        number = F.when(F.col("n_shingles").between(least, most), most).otherwise(number)
    windows = []
    for _, most in classes:
        at = F.floor(F.col("place") / most)
        windows += [F.struct(F.lit(most).alias("class"), w.alias("window")) for w in (at, at - 1)]
    sketch = (
        found.select("doc_id", F.xxhash64("shingle").alias("h"), F.explode(F.array(*windows)).alias("w"))
        .groupBy("doc_id", F.col("w.class").alias("class"), F.col("w.window").alias("window"))
        .agg(*_signature(bands, rows))
        .select("doc_id", "class", _band_keys(bands, rows).alias("band"))
        .distinct()
    )
    index = (
        shingled.withColumn("class", number)
        .select("item_id", "class", F.xxhash64("shingle").alias("h"))
        .groupBy("item_id", "class")
        .agg(*_signature(bands, rows))
        .select("item_id", "class", _band_keys(bands, rows).alias("band"))
    )
    # without the hint the planner might broadcast exploded rows that it takes for few
    return sketch.join(index.hint("merge"), ["class", "band"]).select("doc_id", "item_id").distinct()


def verified(candidates: DataFrame, found: DataFrame, shingled: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Candidates with at least ``threshold`` of the item's distinct shingles anywhere in the document."""
    shared = (
        found.select("doc_id", "shingle").distinct()
        .join(shingled, "shingle")
        .groupBy("doc_id", "item_id", "n_shingles")
        .agg(F.count("*").alias("n_shared"))
    )
    return (
        shared.join(candidates, ["doc_id", "item_id"], "left_semi")
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .filter(F.col("n_shared") >= F.lit(threshold) * F.col("n_shingles") - 1e-9)
        .select("doc_id", "item_id", "n_shingles", "n_shared", "containment")
    )
