"""The training-data operators against brute force, on the smallest driver tables and on awkward rows."""

import hashlib
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from assetlake.llm import bpe_count, chat, containment, decontaminate, fingerprints, licenses, packing, rules, simhash, substring_dedup, tokens, wavelet
from assetlake.llm.components import connected
from assetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_path())


def words(text):
    return (text or "").encode().split()


PASSAGE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"x{i % 977} y{i % 13}" for i in range(30_000))
AWKWARD = [
    (3, PASSAGE), (1, "a b c " + PASSAGE + " d"), (2, None), (4, ""), (5, PASSAGE), (5, PASSAGE), (None, PASSAGE), (None, None),
    (6, "Released under the MIT License."), (7, LONG), (8, "z " * 50), (9, "é ß , <|endoftext|> \x1c Σςİ."), (10, "a b c " + PASSAGE + " d"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "x", 1, 2) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, block string, row int, score int").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def kept_by_brute_force(rows, n=20):
    """Rows (doc_id, text) in order; the digests of what is left, with rows of one id as one document."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if key in seen:
                gone[i : i + n] = [True] * n
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(spark, corpus, awkward, empty):
    got = QUERIES["op1_substring_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == kept_by_brute_force(corpus.items())
    got = substring_dedup.remove_repeats(awkward, block_bytes=2000)
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr) == kept_by_brute_force(AWKWARD)
    texts = {(r["doc_id"], r["row"]): r["text"] for r in got.filter("n_removed > 0").collect()}
    assert texts[3, 0] == "" and texts[1, 0] == "a b c d"
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_automaton_matches_at_words_only():
    machine = substring_dedup.Automaton([(b"a", b"b"), (b"b", b"c", b"d")])
    assert machine.ends([b"a", b"b", b"c", b"d", b"q", b"a", b"b"]) == [1, 3, 6]
    assert substring_dedup.Automaton([]).ends([b"a"]) == []


def edited_by_brute_force(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_fingerprints(spark, corpus, awkward, empty):
    got = QUERIES["op2_fingerprints"](spark, SF).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == edited_by_brute_force(corpus.items())
    same = defaultdict(set)
    for r in got:
        same[corpus[r["doc_id"]]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in same.values())
    assert np.mean([r["near_edited"] for r in got]) > 0.4 > 0.1 > np.median([r["near_next"] for r in got])
    got = fingerprints.fingerprint_documents(awkward).collect()
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == edited_by_brute_force(AWKWARD)
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_chunks_survive_a_shift():
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(800)).encode()
    a, b = fingerprints.chunk_weights(text), fingerprints.chunk_weights(b"new start " + text)
    assert sum(a.values()) <= len(text) and fingerprints.likeness(a, b) > 0.97
    ends = fingerprints.borders(text)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes[:-1].min() >= fingerprints.LEAST and sizes.max() <= fingerprints.MOST
    assert fingerprints.likeness({}, {}) == 1 and fingerprints.likeness({}, a) == 0


def contained_by_brute_force(docs, items, share=0.8):
    def shingles(text):
        w = (text or "").lower()
        for c in "\t\n\x0b\f\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}

    whole = defaultdict(set)
    for i, t in docs:
        if i is not None:
            whole[i] |= shingles(t)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= shingles(t)
    return sorted((d, i) for d, s in whole.items() for i, q in asked.items() if q and len(s & q) >= share * len(q) - 1e-9)


def test_containment(spark, corpus, awkward, empty):
    bench = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op4_decontamination"](spark, SF).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == contained_by_brute_force(corpus.items(), bench)
    got = QUERIES["op3_license_scan"](spark, SF).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == contained_by_brute_force(corpus.items(), licenses.TEMPLATES)
    items = [(1, PASSAGE), (2, "a b c d"), (3, None), (4, " ".join(PASSAGE.split()[:7])), (4, "x1 y1 x2 y2 x3"), (5, "no such words in any text")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contaminated(awkward, frame).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == contained_by_brute_force(AWKWARD, items)
    assert decontaminate.contaminated(empty, frame).count() == 0
    assert decontaminate.contaminated(awkward, frame.limit(0)).count() == 0


def test_bands_guarantee():
    for similarity in (0.16, 0.4, 0.9):
        assert (1 - similarity) ** containment.bands_for(similarity) <= 1e-6


def classes_by_brute_force(prints):
    codes = np.array(sorted(set(prints.values())), np.uint64)
    parent = {int(c): int(c) for c in codes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for c in codes:
        for other in codes[np.bitwise_count(codes ^ c) <= 3]:
            a, b = root(int(c)), root(int(other))
            parent[max(a, b)] = min(a, b)
    least = {}
    for doc, p in prints.items():
        least[root(p)] = min(doc, least.get(root(p), doc))
    return {doc: least[root(p)] for doc, p in prints.items()}


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(lowered[i : i + 3]) for i in range(len(lowered) - 2)] or ([b" ".join(lowered)] if lowered else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, corpus, awkward, empty):
    prints = {i: slow_fingerprint(t) for i, t in corpus.items()}
    got = {r[0]: (r[1], r[2]) for r in QUERIES["op5_simhash"](spark, SF).collect()}
    labels = classes_by_brute_force(prints)
    assert got == {i: (f"{p:016x}", labels[i]) for i, p in prints.items()}
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    assert {r["component_id"] for r in got if r["fingerprint"] == "0" * 16} == {2}
    assert {r["doc_id"] for r in got if r["component_id"] == 1} >= {1, 10}
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_crowds(spark, monkeypatch):
    """A table entry with many members takes the way through codes and gives the same classes."""
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    codes = {centre}
    while len(codes) < 150:
        code = centre
        for bit in rng.sample(range(64), rng.choice((1, 2, 3, 5, 7))):
            code ^= 1 << bit
        codes.add(code)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    expected = classes_by_brute_force({s: c for s, c in zip(signed, codes)})
    for crowd in (4, 1000):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        labels = {r["fp"]: r["label"] for r in simhash.components(spark.createDataFrame([(s,) for s in signed], "fp bigint")).collect()}
        got = {s: labels.get(s, s) for s in signed}
        assert len(set(got.values())) == len(set(expected.values()))
        assert len({(got[s], expected[s]) for s in signed}) == len(set(got.values()))


def test_connected_chain(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 102), (101, 102)]
    got = {r["fp"]: r["label"] for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}


def test_chat_query(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    marks = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [("user", marks), ("assistant", marks)]
    expected = {}
    for conv, rows in turns.items():
        loss = "".join(t for r, t in rows if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in rows)
        expected[conv] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r[0]: tuple(r)[1:5] for r in QUERIES["op6_chat_format"](spark, SF).collect()}
    assert got == expected


def test_chat_events(spark):
    log = [
        (1, 0, 0, "start", "user", "hi"), (1, 1, 1, "start", "assistant", None), (1, 1, 2, "delta", None, "wro"), (1, 1, 3, "regenerate", None, None),
        (1, 1, 4, "delta", None, "ri"), (1, 1, 5, "delta", None, "ght <|im_end|>"), (1, 0, 6, "edit", None, "hello"), (1, 2, 7, "start", "user", "x"), (1, 2, 8, "delete", None, None),
        (2, 0, 0, "start", "a\nb\\n", "<\\| <| <"), (None, 0, 0, "start", "user", "lost"), (2, 1, 0, "what", None, "ignored"),
    ]
    frame = spark.createDataFrame(log, "conv_id bigint, message bigint, seq bigint, kind string, role string, text string")
    rows = chat.format_log(frame.repartition(4)).orderBy("conv_id", "message").collect()
    assert [(r["conv_id"], chat.parse(r["formatted"])) for r in rows] == [(1, ("user", "hello")), (1, ("assistant", "right <|im_end|>")), (2, ("a\nb\\n", "<\\| <| <"))]
    second = rows[1]
    assert chat.unescape(second["formatted"][second["loss_start"] : second["loss_end"]]) == "right <|im_end|>"
    assert chat.read_back(chat.format_log(frame.limit(0))).count() == 0
    for text in ("<|im_start|>", "<\\|im_end|>", "<\\\\|", "a<", "<<|>|"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_chat_turn_numbers(spark):
    """Null, tied and very large turn numbers, and null conversations, keep all their turns in order."""
    big = 2**62
    turns = [(1, big, "user", "d"), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "a"), (1, None, "user", "n"), (1, big + 1, "user", "e"), (1, -big, "user", "m"), (None, 0, "user", "x")]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_log(chat.events_of(frame))).collect()}
    ordered = ["user\nn", "user\nm", "assistant\na", "user\nb", "user\nb", "user\nd", "user\ne"]
    assert got[1]["n_turns"] == 7 and got[None]["n_turns"] == 1
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{t}\n" for t in ordered).encode()).hexdigest()
    log = [(1, number, rank, 0, "start", "user", f"{number}.{rank}") for number, rank in ((0, 1_000_000), (1, 0), (0, 2))]
    frame = spark.createDataFrame(log, "conv_id bigint, message bigint, rank bigint, seq bigint, kind string, role string, text string")
    rows = chat.format_log(frame).orderBy("message", "rank").collect()
    assert [chat.parse(r["formatted"])[1] for r in rows] == ["0.2", "0.1000000", "1.0"]


def test_quality(spark, awkward, empty):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, sf).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[i]["predicted"], q) for i, q in labels if got[i]["held_out"]]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = rules.fit(rules.training_rows(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    out = rules.classify(awkward, model)
    assert out.count() == len(AWKWARD) and out.columns == ["doc_id", "text", "block", "row", "score", "predicted"]
    assert rules.classify(empty, model).count() == 0
    none = rules.fit(rules.training_rows(empty, spark.createDataFrame([], "doc_id bigint, quality int")))
    assert {r["score"] for r in rules.classify(awkward, none).collect()} == {0.5}


def test_rule_paths():
    tree = "DecisionTree\n  If (feature 3 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 1.0\n   Else (feature 1 > 2.0)\n    Predict: 0.0\n  Else (feature 3 > 0.5)\n   Predict: 0.0\n"
    a, b, c = (rules.STATISTICS[3], "<=", 0.5), (rules.STATISTICS[1], "<=", 2.0), (rules.STATISTICS[1], ">", 2.0)
    assert rules.paths(tree) == [(a,), (a, b), (a, c), ((rules.STATISTICS[3], ">", 0.5),)]
    assert rules.simplified((a, (rules.STATISTICS[3], "<=", 0.25))) == ((rules.STATISTICS[3], "<=", 0.25),)


def packed_right(rows, docs, tokenizer):
    expected = defaultdict(list)
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected[i, piece].append((at, len(part), zlib.crc32(part.tobytes())))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), -(-sum(x[1] for v in expected.values() for x in v) // 2048)


def test_packing(spark, corpus, awkward, empty, tokenizer):
    used, least = packed_right(QUERIES["op8_packing"](spark, SF).collect(), corpus.items(), tokenizer)
    assert used <= least * 1.02 + 1
    packed_right(packing.pack(awkward).collect(), AWKWARD, tokenizer)
    assert packing.pack(empty).count() == 0


def test_plan_uses_all_pieces():
    rng = random.Random(5)
    for capacity in (7, 30, 100):
        counts = [0] + [rng.choice((0, 1, 2, 9)) for _ in range(capacity)]
        runs = packing.plan(counts, capacity)
        used = [0] * (capacity + 1)
        for lengths, times in runs:
            assert sum(lengths) <= capacity and times > 0
            for x in lengths:
                used[x] += times
        assert used == counts
    assert packing.plan([0, 4, 0, 0, 0, 0, 0, 4, 0, 0, 0], 10)[0] != ()
    assert packing.plan([0] * 11, 10) == []


def test_token_counts(spark, corpus, awkward, empty, tokenizer):
    def expected(rows):
        out = []
        for i, t in rows:
            n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
            out.append((i, len((t or "").encode()), n, n > 2048))
        return sorted(out, key=repr)

    assert sorted(map(tuple, QUERIES["op9_token_counts"](spark, SF).collect()), key=repr) == expected(corpus.items())
    assert sorted(map(tuple, bpe_count.count_tokens(awkward).collect()), key=repr) == expected(AWKWARD)
    assert bpe_count.count_tokens(empty).count() == 0


def test_words_give_the_tokenizers_ids(tokenizer):
    rng = random.Random(5)
    letters = list("abcXY.,.,'!?<|> \n\t\x0b\x1c\x85 ​éÉßΣςİı字٣½²́😀") + ["<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", "'s", "end,", "It's."]
    ids, counter = tokens.WordIds(tokens.default_path()), bpe_count.Counter(tokens.default_path())
    for _ in range(1500):
        text = "".join(rng.choices(letters, k=rng.randrange(30)))
        found = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.encode([text.encode()])[0], "<u4").tolist() == found, text
        assert counter.count(text.encode()) == len(found), text


def test_wavelet_query(spark, corpus, awkward, empty, tokenizer):
    def expected(rows):
        out, start = [], 0
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        return sorted(out, key=repr)

    assert sorted(map(tuple, QUERIES["op10_wavelet_corpus"](spark, SF).collect()), key=repr) == expected(corpus.items())
    assert sorted(map(tuple, wavelet.corpus_file(awkward).collect()), key=repr) == expected(AWKWARD)
    assert wavelet.corpus_file(empty).count() == 0


@pytest.mark.parametrize("n,top", [(1, 1), (5, 1), (3000, 300), (3000, 60_000)])
def test_wavelet_matrix(n, top):
    ids = (np.random.default_rng(n).zipf(1.3, n) % top).astype(np.uint32)
    matrix, _, _ = wavelet.from_bytes(wavelet.to_bytes(ids, [1], [0]))
    assert (matrix.ids() == ids).all()
    for i in range(0, n, max(1, n // 25)):
        value = int(ids[i])
        places = np.flatnonzero(ids == value)
        assert matrix.access(i) == value and matrix.count(value) == len(places) and matrix.count(value, i) == (places < i).sum()
        assert [matrix.locate(value, k) for k in (0, len(places) - 1)] == [places[0], places[-1]]
    assert matrix.count(10**6) == 0


def test_word_ids_with_small_generations(monkeypatch):
    """Ids of texts put together from kept words are the library's, also when generations change within a few texts."""
    monkeypatch.setattr(tokens, "KEPT_WORDS", 20)
    monkeypatch.setattr(tokens, "KEPT_STEMS", 15)
    encoder, library = tokens.WordIds(tokens.default_path()), Tokenizer.from_file(tokens.default_path())
    parts = ["a", "B", "é", "É", "é", "'s", "'", "LL", "...", "%", "<", "<|endoftext|>", " ", "\n", "\x0b", "\x1c", "\x85", " ", "1", "23", "…", "̸", "=", "日", "x" * 70, "\u0000"]
    rng = random.Random(3)
    for _ in range(600):
        texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(rng.randrange(5))]
        want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
        assert encoder.encode([t.encode() for t in texts]) == want
    assert max(len(g.young) for g in (encoder.known, encoder.stems)) < 200


def test_word_ids_keep_stems_not_words():
    """Words that differ in case or in marks at the end are one kept string; nothing is kept for each of them."""
    encoder, library = tokens.WordIds(tokens.default_path()), Tokenizer.from_file(tokens.default_path())
    texts = ["Wind wind, WIND! wind.", "<b>Wind wind,"]
    want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert encoder.encode([t.encode() for t in texts]) == want
    assert set(encoder.stems.young) - {b""} == {b"wind"}
    assert set(encoder.known.young) == {b",", b"!", b".", b"<b>Wind"}
