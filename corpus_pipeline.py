"""From raw documents to packed training sequences: quality, near copies, repeated passages, test items, packing.

A stage takes (spark, docs, sf_dir) and returns the next stage's documents, in the columns of ``docs``; the last one
returns the packed pieces. Each works on all its predecessor kept. Rows with null doc_id and rows that share a doc_id are
judged like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assetlake.llm import decontaminate, packing, rules, simhash, substring_dedup
from assetlake.llm.storage import table, written

ORACLE_SQL = None  # the classifier is fitted; tests/llm compares every stage with brute force


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.3 or more; it is fitted on labels outside the held-out fold."""
    model = rules.fit(rules.training_rows(docs.select("doc_id", "text"), table(spark, sf_dir, "labels")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    held = docs.select(F.struct(*columns).alias("doc"), F.col("text").alias("text"))
    return rules.classify(held, model).filter("predicted = 1").select("doc.*")


def _held(docs: DataFrame) -> DataFrame:
    """docs as a struct with a number of the row, written so that the numbers stay."""
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return written(docs.select(F.monotonically_increasing_id().alias("_row"), held), "rows")


_KEY = ["id", "no_id", "digest"]


def _key(doc_id: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id")]


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of op5: the one with the smallest doc_id, null last; a class is of rows, also of rows of one id."""
    rows = _held(docs)
    classes = simhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "doc.text"))
    ids = rows.select("_row", F.col("doc.doc_id").alias("_id"), F.xxhash64("doc.text").alias("_digest"))
    named = written(ids.join(classes.select(F.col("doc_id").alias("_row"), "component_id"), "_row"), "row-classes")
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_digest", "_row")).alias("best"))
    others = written(named.join(best, "component_id").filter("_row != best._row").select("_row"), "near-copies")
    return rows.join(others, "_row", "left_anti").select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of passages that occur earlier; n_chars, if there, follows the text."""
    cut = substring_dedup.remove_repeats(docs).filter("n_removed > 0")
    texts = F.collect_set(F.struct((F.col("copy") > 0).alias("later"), F.col("text").alias("new")))  # later copies are cut alike
    keyed = cut.select(*_key(F.col("doc_id")), "digest", "copy", "text").groupBy(*_KEY).agg(texts.alias("cuts"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    held = held.select("doc", *_key(F.col("doc.doc_id").cast("bigint")), substring_dedup.text_digest(F.col("doc.text")).alias("digest"))
    copies = held.withColumn("later", F.row_number().over(Window.partitionBy(*_KEY).orderBy("digest")) > 1)  # any order of equal rows
    joined = copies.join(keyed, _KEY, "left")
    joined = joined.withColumn("_new", F.get(F.filter("cuts", lambda c: c["later"] == F.col("later")), 0)["new"])
    changed = F.coalesce(F.col("_new"), F.col("doc.text"))
    out = []
    for c in docs.columns:
        value = F.col(f"doc.`{c}`")
        if c == "text":
            value = changed
        elif c == "n_chars":
            value = F.when(F.col("_new").isNull(), value).otherwise(F.length("_new").cast(docs.schema[c].dataType))
        out.append(value.alias(c))
    return joined.select(*out)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item; each row is judged by itself, under a hash of its id and text."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = held.withColumn("_row", F.xxhash64(F.col("doc.doc_id"), F.col("doc.text")))
    found = decontaminate.contaminated(rows.select(F.col("_row").alias("doc_id"), "doc.text"), table(spark, sf_dir, "benchmark"))
    hit = written(found.select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    return rows.join(hit, "_row", "left_anti").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packing.pack(docs)


test_items.__test__ = False  # a stage, not a test

STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", test_items),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
