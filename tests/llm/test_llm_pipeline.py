"""The corpus pipeline, stage by stage on a small table, against the operators' brute-force versions."""

import pytest

import corpus_pipeline as pipeline
from test_llm_operators import AWKWARD, LONG, PASSAGE, classes_by_brute_force, contained_by_brute_force, packed_right, slow_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, label string")


def test_stages_keep_columns(spark, docs):
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), SF).count() == 0


def _kept(rows):
    """One row of each class of near copies: the smallest id, null ids last."""
    classes = classes_by_brute_force({k: slow_fingerprint(t) for k, (_, t) in enumerate(rows)})
    best = {}
    for k, (i, t) in enumerate(rows):
        best[classes[k]] = min(best.get(classes[k], (True, 0, k)), (i is None, i or 0, k))
    return sorted((None if none else i for none, i, _ in best.values()), key=repr)


def test_near_copies(spark, docs):
    kept = pipeline.near_copies(spark, docs, SF).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == _kept(AWKWARD)


def test_near_dedup_stage(spark):
    """The stage keeps one document of each class of the operator, among copies with few and many changed words."""
    import random

    rng, texts = random.Random(3), ["", None, "a b", "A b", PASSAGE]
    for base in range(8):
        words = [f"v{rng.randrange(10**6)}" for _ in range(150)]
        for changed in (0, 0, 1, 1, 1, 2, 3, 6, 12):
            other = list(words)
            for at in rng.sample(range(150), changed):
                other[at] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(other))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[6]), (None, "only here, without an id"), (None, "only here, without an id")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted((r["doc_id"] for r in dict(pipeline.STAGES)["simhash_near_dedup"](spark, frame, SF).collect()), key=repr)
    assert got == _kept(rows) and len(got) < len(rows)


def test_rows_of_one_id(spark):
    """Rows that share an id stay unless they are near copies themselves."""
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(4)]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (7, texts[2]), (5, texts[2]), (9, texts[3])]
    got = pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), SF).collect()
    assert sorted(map(tuple, got)) == sorted([(7, texts[0]), (7, texts[1]), (5, texts[2]), (9, texts[3])])


def test_contaminated_rows(spark):
    """A row that holds a test item goes whatever its id; other rows of that id and of no id stay."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = " ".join(f"c{i}" for i in range(30))
    rows = [(1, item), (1, clean), (None, f"{clean} {item}"), (None, clean), (2, None), (3, "")]
    got = pipeline.test_items(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, clean), (None, clean), (2, None), (3, "")], key=repr)


def test_copies_of_one_id(spark):
    """Equal rows of one id: the first keeps its words, the others lose theirs."""
    other = " ".join(f"o{i}" for i in range(25))
    rows = [(4, PASSAGE), (4, PASSAGE), (4, PASSAGE), (4, other), (None, other), (9, f"start {other} end")]
    got = pipeline.repeated_passages(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(4, PASSAGE), (4, ""), (4, ""), (4, ""), (None, other), (9, "start end")], key=repr)


def test_repeated_passages(spark, docs):
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in pipeline.repeated_passages(spark, docs, SF).collect()}
    assert (None, PASSAGE, len(PASSAGE)) in rows  # null ids come first
    assert (1, "a b c d", 7) in rows and (3, "", 0) in rows and (2, None, 0) in rows and (7, LONG, len(LONG)) not in rows


def test_whole_pipeline(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, sizes = raw, []
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        sizes.append(kept.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] < raw.count()
    ids = {r["doc_id"] for r in pipeline.quality(spark, raw, SF).select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) > 0.98 * len(good)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert contained_by_brute_force(rows, bench) == []
    from tokenizers import Tokenizer

    from assetlake.llm.tokens import default_path

    used, least = packed_right(pipeline.run(spark, SF).collect(), rows, Tokenizer.from_file(default_path()))
    assert used <= least * 1.02 + 1
