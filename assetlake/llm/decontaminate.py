"""Benchmark decontamination: test items inside long documents, by size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into classes whose sizes double. Within a class the containment
threshold t becomes a Jaccard bound: a window of two class sizes that holds t of an item of size s and u other item
shingles has a Jaccard similarity of at least t*s / (s + u). With u up to a whole window and s half the class size this
is t / (1 + 4); ``BANDS`` is set for it. See ``containment`` for texts, nulls and ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.containment import THRESHOLD, bands_for, hits, item_shingles, retrieve, verified

BANDS = bands_for(THRESHOLD / 5)


def size_classes(shingled: DataFrame) -> list[tuple[int, int]]:
    """Ranges (2**k / 2 + 1, 2**k) of item sizes in use; as many as the sizes' logarithm."""
    power = F.ceil(F.log2(F.col("n_shingles"))).cast("int")
    used = sorted(r[0] for r in shingled.select(power.alias("power")).distinct().collect())
    return [(2**k // 2 + 1 if k else 1, 2**k) for k in used]


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of documents (doc_id, text) and the items (item_id, text) they contain, with the shared share."""
    shingled = item_shingles(items)
    found = hits(docs, shingled)
    classes = size_classes(shingled) or [(1, 1)]
    return verified(retrieve(found, shingled, classes, BANDS), found, shingled, threshold)
