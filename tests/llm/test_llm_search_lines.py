"""Importance resampling, line dedup and lexical search against brute force and SQL, also on awkward rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest

from assetlake.llm import lexical_search, line_dedup, resample
from assetlake.llm.queries import ORACLES, QUERIES
from assetlake.llm.terms import batch_terms, terms

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
LINE = "  A Line That Is Shared by Many \t"
TEXTS = [
    (3, f"{LINE}\none\n{LINE.lower()}\n\ntwo"), (1, f"x\n{LINE}"), (7, f"{LINE.strip()}\nÉé and ÀÇ stay as they are"), (2, None), (4, ""), (5, "\n"), (5, LINE), (5, LINE),
    (None, f"{LINE}\nnull id"), (None, None), (6, "Éé and ÀÇ stay as they are\nshort line\n"), (8, "éé and àç stay as they are\nshort line"), (9, "Éé AND ÀÇ stay as they are\nshort line\r"),
    (10, " ".join(f"w{i % 501} Émile{i % 7}" for i in range(40_000))), (11, "one two, one-two; THREE\x00four\x1c" * 9), (12, "one two three four five six seven " * 4), (12, "one two three four five six seven " * 4),
    (13, "twelve code points é"), (14, "\x0b twelve code points é \f"), (15, "Twelve Code Points é\nno"),
]
ITEMS = [(0, "one two THREE"), (1, "w1 w2 émile1 Émile2"), (2, None), (3, "nothing-like"), (4, "seven"), (4, "five seven"), (None, "four"), (6, "")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "n", 2, "g") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, pos int, lines string, score int, rank string").repartition(4)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 9) for i, t in ITEMS], "item_id bigint, text string, rank int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def collected(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


def slow_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_line_dedup", "op13_lexical_search"])
def test_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    rows = db.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]}) q").fetchall()
    assert len(rows) > 100 and sorted(rows, key=repr) == collected(got, *got.columns)


def test_terms():
    texts = ["A-b É9\x00ça", "", "\x00x\x00", "Z" * 5]
    found, owner = batch_terms([t.encode() for t in texts])
    assert [(w.decode(), int(o)) for w, o in zip(found, owner)] == [(w, k) for k, t in enumerate(texts) for w in slow_terms(t)]
    assert terms(b"") == [] and batch_terms([b""])[0] == [] and batch_terms([])[0] == []


def resampled(rows, target, order, buckets, least, percent):
    def features(text):
        w = slow_terms(text)
        return [crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, order + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(f for _, x in side for f in features(x)) for side in (rows, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * float(s.total() + buckets) / ((s[b] + 1) * float(t.total() + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in features(text))
        out.append((i, len(slow_terms(text)), len(features(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    asked = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = asked[: percent * len(asked) // 100]
    rest = asked[len(drawn) :] + [r for r in out if r[1] < least]
    return sorted([(r[0], *r[2:], k + 1) for k, r in enumerate(drawn)] + [(r[0], *r[2:], None) for r in rest], key=repr)


@pytest.mark.parametrize("order,buckets,least,percent", [(1, 10_000, 20, 10), (3, 50, 2, 60), (2, 1000, 0, 100)])
def test_resample(docs, items, order, buckets, least, percent):
    got = resample.resample(docs, items, buckets, order, least, percent)
    assert collected(got, *got.columns) == resampled(TEXTS, ITEMS, order, buckets, least, percent)


def test_resample_of_nothing(spark, docs, empty):
    assert resample.resample(empty, docs).count() == 0
    got = resample.resample(docs, empty)
    assert collected(got, *got.columns) == resampled(TEXTS, [], 1, 10_000, 20, 10)
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert [r["rank"] for r in resample.resample(blank, empty).collect()] == [None, None]


def test_rank_over_ranges(spark):
    """Ties and one id in a third of the rows."""
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS doc_id", "id % 4 AS score", "id AS row").repartition(7)
    from pyspark.sql import functions as F

    got = resample.ranked(rows, [F.col("score").desc(), "doc_id", "row"], 1700).collect()
    want = sorted(((r["score"], r["doc_id"], r["row"]) for r in got), key=lambda r: (-r[0], r[1], r[2]))
    place = {r["row"]: r["rank"] for r in got}
    assert [place[r[2]] for r in want] == [*range(1, 1701), *[None] * 1300]


def without_lines(rows, least_chars=20, least_docs=3):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    low = -(2**63)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(low if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least_docs or max(holders[key(x)]) == (low if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_chars,least_docs", [(20, 3), (1, 2), (0, 1), (26, 4)])
def test_line_dedup(docs, least_chars, least_docs):
    got = line_dedup.drop_lines(docs, least_chars, least_docs)
    want = without_lines(TEXTS, least_chars, least_docs)
    assert collected(got, "doc_id", "text", "n_lines", "n_dropped", "kept_sha256") == want
    assert len(want) == len(TEXTS) and (least_docs == 1 or any(r[3] for r in want))


def test_line_dedup_of_nothing_and_one_id(spark, empty):
    assert line_dedup.drop_lines(empty).count() == 0
    rows = [(1, f"{LINE}\n{k}") for k in range(40)] + [(k, LINE) for k in (2, 3, 9)]
    got = line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    assert collected(got, "doc_id", "text", "n_lines", "n_dropped", "kept_sha256") == without_lines(rows)


def searched(rows, items, k):
    held = [(i, slow_terms(t)) for i, t in rows]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(slow_terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c, n in held:
            m = 100 - 50 + ((50 * n * n_docs) // n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            found.append((score, i))
        found = sorted((f for f in found if f[0] > 0), key=lambda f: (-f[0], f[1] is not None, f[1] or 0))[:k]
        out += [(item, rank + 1, i, score) for rank, (score, i) in enumerate(found)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k,block", [(50, 1 << 20), (2, 20)])
def test_search(docs, items, monkeypatch, k, block):
    if k == 2:  # several item, document and vocabulary tiles
        monkeypatch.setattr(lexical_search, "ITEM_TILE", 1)
        monkeypatch.setattr(lexical_search, "DOC_TILE", 3)
    got = lexical_search.search(docs, items, k, block)
    want = searched(TEXTS, ITEMS, k)
    assert collected(got, *got.columns) == want and {r[0] for r in want} == {0, 1, 4, None}


def test_partial_sums_stay_exact():
    """Vocabulary tiles end before a sum can reach the bound, and together hold every term once."""
    block = lexical_search.Block({1: {b"a", b"b", b"c", b"d", b"e"}, 2: {b"b", b"z"}})
    weight = np.array([3, 9, 4, 1, 5, 7], np.int64)
    tiles = list(block.tiles(weight, 2, 2 * 9 * lexical_search.IMPACT_BOUND))
    assert [len(v) for _, v, _ in tiles] == [2, 2, 2]
    assert sum(t.sum() for _, _, t in tiles) == 3 + 9 + 4 + 1 + 5 + 9 + 7
    assert max(t.sum(axis=1).max() for _, _, t in tiles) * lexical_search.IMPACT_BOUND <= 2 * 9 * lexical_search.IMPACT_BOUND


def test_ties_at_the_cut():
    scores, ids = np.array([5, 7, 7, 0, 7, 9, 5]), np.array([1, 8, 2, 0, 0, 4, 0])
    nulls = np.array([False, False, False, False, True, False, False])
    assert lexical_search.best_places(scores, ids, nulls, 3).tolist() == [5, 4, 2]
    assert lexical_search.best_places(scores, ids, nulls, 9).tolist() == [5, 4, 2, 1, 6, 0]


def test_search_of_nothing(docs, items, empty):
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
