"""Line dedup: lines that many documents share stay in one document only.

Texts are cut at line feeds, lines are normalised (white space 0x20, 0x09 to 0x0D stripped at both ends, A-Z lowered) and
hashed to 128 bits. Distinct documents are counted for each hash; a key of at least ``least_chars`` code points in
``least_docs`` documents or more goes from all documents but the one with the largest doc_id. A row's dropped positions
are gathered and the lines between them are joined again.

A common line has one row for each document that holds it: these are counted by (hash, document) first, so no task
counts a line alone, and the dropped hashes are joined to the lines with one row for each hash, so Spark can split a
crowded partition of lines. Texts move once, to the positions of their dropped lines.

Null and empty texts are one empty line. Rows that share a doc_id are one document; each row is returned. Null doc_ids are one document, smaller
than any other. Rows are told apart by doc_id and a 64-bit hash of the text: equal rows lose equal lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.llm.storage import written

LEAST_CHARS, LEAST_DOCS = 20, 3
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(2**63)


def normalised(line: Column) -> Column:
    """The key of a line."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _SMALL))  # lower() would change letters beyond A-Z


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("digest", F.xxhash64("text"))


def _lines(rows: DataFrame, least_chars: int) -> DataFrame:
    """doc, digest, pos and hashes (h, g) of the lines whose keys are long enough."""
    split = rows.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), "digest", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = split.filter(F.char_length("line") >= least_chars).select("doc", "digest", "pos", normalised(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= least_chars).select("doc", "digest", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))


def shared_lines(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Hashes (h, g) found in ``least_docs`` documents or more, and the largest document (keeper)."""
    once = lines.select("h", "g", "doc").distinct()
    return once.groupBy("h", "g").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper")).filter(F.col("n_docs") >= least_docs)


def drop_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, text (kept lines), n_lines (before), n_dropped and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    rows = _rows(docs)
    lines = written(_lines(rows, least_chars), "lines")
    shared = written(shared_lines(lines, least_docs).select("h", "g", "keeper"), "shared-lines")
    gone = (
        lines.join(shared, ["h", "g"]).filter("doc != keeper")
        .groupBy("doc", "digest").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    )
    held = rows.withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID))).join(gone, ["doc", "digest"], "left")
    cut = held.select("doc_id", F.split("text", "\n", -1).alias("lines"), "text", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    borders = F.concat(F.array(F.lit(-1)), "gone", F.array(F.size("lines")))
    cut = cut.withColumn("borders", borders)
    between = F.transform(
        F.sequence(F.lit(0), F.size("gone")),
        lambda i: F.slice("lines", F.get("borders", i) + 2, F.get("borders", i + 1) - F.get("borders", i) - 1),
    )
    kept = F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(F.flatten(between), "\n"))
    out = cut.select("doc_id", kept.alias("text"), F.size("lines").cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_dropped"))
    return out.withColumn("kept_sha256", F.sha2("text", 256))
