"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts come from numpy over Arrow batches (``statistics``). A forest of shallow trees is fitted on
them; every path from a root to a node is a rule, a conjunction of comparisons. A lasso logistic regression weighs the
rules, most weights become zero, and what is left is compiled to one Spark column: the logistic function of the
intercept plus the weights of the rules that hold.

Labels: 1 is good. About ``SAMPLE_ROWS`` labelled rows at most (by a hash of doc_id) are used for fitting; null labels and
labels without a document are not used. With fewer than two classes every score is that class's label (0.5 without labels).
Null and empty texts have all statistics zero and get a score like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from assetlake.llm.batches import Words, byte_texts, pieces
from assetlake.llm.storage import written
from assetlake.llm.tokens import release

SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO = 20, 3, 0.002
KEEP_SCORE = 0.3
STATISTICS = (
    "n_bytes n_words word_bytes upper_share digit_share mark_share symbol_share bar_share break_share high_share "
    "repeat_share same_next_share mark_end_share"
).split()


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, np.float64)
    out[list(chars.encode())] = 1
    return out


_CLASSES = np.stack([
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("!?"), _class("#$%&*+=@^~<>{}[]\\_"), _class("|"), _class("\n"),
    np.array([0.0] * 128 + [1.0] * 128),
])
_MARK = np.zeros(256, bool)
_MARK[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def text_statistics(values: list[bytes]) -> np.ndarray:
    """A row of ``STATISTICS`` for each text."""
    out = np.zeros((len(values), len(STATISTICS)))
    words = Words(values)
    hashes = words.hashes()
    ends = _MARK[words.data[words.ends - 1]] if len(words.ends) else np.zeros(0, bool)
    lengths = words.ends - words.starts
    for i, value in enumerate(values):
        if not value:
            continue
        n = len(value)
        counts = np.bincount(words.data[words.offsets[i] : words.offsets[i] + n], minlength=256)
        a, b = words.first[i], words.first[i + 1]
        row = out[i]
        row[0], row[1] = n, b - a
        row[3:10] = _CLASSES @ counts / n
        if b > a:
            own = hashes[a:b]
            row[2] = lengths[a:b].mean()
            row[10] = 1 - len(np.unique(own)) / (b - a)
            row[11] = (own[1:] == own[:-1]).sum() / (b - a)
            row[12] = ends[a:b].mean()
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()  # a worker that packed before holds up to a few hundred MB of words
    for batch in batches:
        values = byte_texts(batch.column(1))
        parts = [text_statistics(values[lo:hi]) for lo, hi in pieces(values)]
        columns = np.concatenate(parts).T if parts else np.zeros((len(STATISTICS), 0))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in columns]], ["row", *[f"_{s}" for s in STATISTICS]])


def statistics(rows: DataFrame) -> DataFrame:
    """A struct column ``row`` with the columns of ``rows``, and a column ``_name`` for each of ``STATISTICS`` of text."""
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    schema = StructType([StructField("row", held.schema["row"].dataType), *[StructField(f"_{s}", DoubleType()) for s in STATISTICS]])
    return held.mapInArrow(_statistics, schema)


Test = tuple[str, str, float]  # statistic, "<=" or ">", bound


def paths(tree: str) -> list[tuple[Test, ...]]:
    """All paths from the root to an inner node's branch or a leaf, from a tree's printed form."""
    out: list[tuple[Test, ...]] = []
    stack: list[tuple[int, Test]] = []
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            depth = len(m[1])
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, (STATISTICS[int(m[2])], m[3], float(m[4]))))
            out.append(tuple(t for _, t in stack))
    return out


def simplified(rule: tuple[Test, ...]) -> tuple[Test, ...]:
    """The tightest bound of each side of each statistic, in order."""
    best: dict[tuple[str, str], float] = {}
    for name, side, bound in rule:
        have = best.get((name, side), bound)
        best[name, side] = min(have, bound) if side == "<=" else max(have, bound)
    return tuple(sorted((name, side, bound) for (name, side), bound in best.items()))


def rule_column(rule: tuple[Test, ...]) -> Column:
    condition = F.lit(True)
    for name, side, bound in rule:
        condition = condition & ((F.col(f"_{name}") <= bound) if side == "<=" else (F.col(f"_{name}") > bound))
    return condition


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``score`` is a column over the statistics."""

    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(labelled: DataFrame, seed: int = 7) -> RuleModel:
    """Model of rows (doc_id, text, label 0/1)."""
    known = labelled.select("doc_id", "text", F.col("label").cast("int").alias("label")).filter("label in (0, 1)")
    chosen = written(statistics(known).select(F.col("row.label").alias("label"), *[f"_{s}" for s in STATISTICS]), "labelled")
    counts = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        only = next(iter(counts), None)
        return RuleModel(0.0 if only is None else 40.0 if only else -40.0, ())
    inputs = [f"_{s}" for s in STATISTICS]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(chosen)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, labelCol="label", seed=seed, featureSubsetStrategy="onethird").fit(vectors)
    rules = sorted({simplified(p) for tree in forest.trees for p in paths(tree.toDebugString)})
    if not rules:
        return RuleModel(float(np.log(counts[1] / counts[0])), ())
    held = chosen.select("label", F.array(*[rule_column(r).cast("double") for r in rules]).alias("held"))
    tested = written(held, "rules-held").select("label", array_to_vector("held").alias("features"))
    lasso = LogisticRegression(labelCol="label", regParam=LASSO, elasticNetParam=1.0, maxIter=60).fit(tested)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w)
    return RuleModel(float(lasso.intercept), kept)


def held_out(doc_id: Column) -> Column:
    """Rows never used for fitting: CRC-32 of the id as text leaves no remainder by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and label of documents whose label may be learned, ``sample_rows`` of them or about so many.

    The rows are chosen by a hash of doc_id. Labels that contradict each other for one document count as the larger one.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
    usable = usable.filter(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = usable.count()
    if n > sample_rows:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(1_000_000 * sample_rows / n))
    # about sample_rows rows of two numbers, so every task may hold them
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(usable), "doc_id")


def classify(docs: DataFrame, model: RuleModel) -> DataFrame:
    """Columns of ``docs`` with score and predicted (1 if the score is ``KEEP_SCORE`` or more), in place of any so named."""
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = statistics(docs).withColumn("score", model.score())
    return scored.select(*kept, "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))
