"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm import bpe_count, chat, decontaminate, fingerprints, lexical_search, licenses, line_dedup, packing, resample, rules, simhash, substring_dedup, wavelet
from assetlake.llm.storage import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return wrap


def _containment_sql(items: str) -> str:
    """Exact shingle containment of items (item_id, text) in documents."""
    words = r"list_filter(string_split(translate(lower(text), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda w: w <> '')"
    shingled = "SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM {rows}_words WHERE len(w) >= 5)"
    return f"""
    WITH items AS ({items}),
    item_words AS (SELECT item_id, {words} AS w FROM items),
    doc_words AS (SELECT doc_id, {words} AS w FROM documents),
    item_shingles AS ({shingled.format(key='item_id', rows='item')}),
    doc_shingles AS ({shingled.format(key='doc_id', rows='doc')}),
    sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
    shared AS (
        SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY ALL
    )
    SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
    FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9"""


_TEMPLATES = ", ".join("({}, '{}')".format(i, t.replace("'", "''")) for i, t in licenses.TEMPLATES)


@query("op1_substring_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op3_license_scan", _containment_sql(f"SELECT item_id, text FROM (VALUES {_TEMPLATES}) t(item_id, text)"))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.templates(spark))


@query("op4_decontamination", _containment_sql("SELECT item_id, text FROM benchmark"))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


_MARKS = "<|im_end|><|im_start|>assistant ok"


@query("op6_chat_format")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_MARKS).alias("text")
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return chat.read_back(chat.format_log(chat.events_of(turns.unionByName(extra))))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit(rules.training_rows(docs, table(spark, sf_dir, "labels")))
    return rules.classify(docs, model).select("doc_id", rules.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(table(spark, sf_dir, "documents"))


@query("op10_wavelet_corpus")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.corpus_file(table(spark, sf_dir, "documents"))


_LOWERED = "translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(" + _LOWERED.format(text="text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# a word's crc32 is folded over its bytes with the usual table, made by the polynomial's rule
_RESAMPLE_SQL = f"""
    WITH step AS (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) AS c
        FROM range(256) r(i)
    ),
    crc AS (SELECT list(c ORDER BY i) AS byte FROM step),
    held AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS words FROM documents),
    doc_words AS (SELECT row, unnest(words) AS word FROM held),
    item_words AS (SELECT unnest({_TERMS}) AS word FROM benchmark),
    words AS (SELECT DISTINCT word FROM (SELECT word FROM doc_words UNION ALL SELECT word FROM item_words)),
    bytes AS (SELECT word, list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS b FROM words),
    known AS (SELECT word, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, byte[1 + xor(c, x) % 256]), 4294967295)) % 10000 AS bucket FROM bytes, crc),
    s AS (SELECT bucket, count(*) AS s FROM doc_words JOIN known USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM item_words JOIN known USING (word) GROUP BY bucket),
    sums AS (SELECT CAST((SELECT coalesce(sum(s), 0) FROM s) AS DOUBLE) AS sum_s, CAST((SELECT coalesce(sum(t), 0) FROM t) AS DOUBLE) AS sum_t),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1) * (sum_s + 10000)) / ((coalesce(s, 0) + 1) * (sum_t + 10000)))) AS BIGINT) AS gain
        FROM (SELECT DISTINCT bucket FROM known) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums
    ),
    weights AS (SELECT row, sum(gain) AS weight FROM doc_words JOIN known USING (word) JOIN gains USING (bucket) GROUP BY row),
    scored AS (
        SELECT row, doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
            CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
        FROM held LEFT JOIN weights USING (row)
    ),
    placed AS (
        SELECT doc_id, n_features, weight, weight + noise AS score, n_features >= 20 AS asked,
            row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id NULLS FIRST) AS place,
            count(*) FILTER (WHERE n_features >= 20) OVER () AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN asked AND place <= 10 * n // 100 THEN place END AS rank FROM placed"""


@query("op11_importance_resampling", _RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LINES_SQL = f"""
    WITH held AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (SELECT row, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM held),
    keyed AS (SELECT *, {_LOWERED.format(text="trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
    shared AS (
        SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 3
    ),
    marked AS (SELECT row, doc_id, line, pos, keeper IS NOT NULL AND keeper <> coalesce(doc_id, -9223372036854775808) AS gone FROM keyed LEFT JOIN shared USING (key))
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY row"""


@query("op12_line_dedup", _LINES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


_SEARCH_SQL = f"""
    WITH held AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS words FROM documents),
    sized AS (SELECT row, doc_id, len(words) AS n FROM held WHERE len(words) > 0),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized),
    counts AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM held) GROUP BY row, term),
    asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
        FROM counts, totals WHERE term IN (SELECT term FROM asked) GROUP BY term
    ),
    scored AS (
        SELECT item_id, row, any_value(doc_id) AS doc_id,
            CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sized USING (row), totals GROUP BY item_id, row
    ),
    placed AS (
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50"""


@query("op13_lexical_search", _SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
