"""Substring dedup: words in a passage that already occurs earlier in the corpus are removed.

A window is ``WINDOW`` consecutive words. Every window holds a phrase of ``PHRASE`` words that is chosen by its hash
alone, so equal windows choose equal phrases. The phrases' hashes are counted over the corpus; those that occur more
than once are sent to the blocks of documents that hold them (one row for a block and phrase, however often it occurs),
and each block compiles its phrases to an Aho-Corasick automaton through which all documents of the block stream. Only
windows around a located phrase are candidates; their earliest place is found by a minimum over a 96-bit window hash.

Words: null and empty texts have none. Order: (doc_id, place), null ids first; rows that share a doc_id are one
document, its rows ordered by text, with no window across two rows; each row is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.batches import Words, byte_texts, gram_hashes, inside, pieces, sliding
from assetlake.llm.storage import written

WINDOW, PHRASE = 20, 8
BLOCK_BYTES = 8 << 20  # text of a block of documents; an automaton holds one block's phrases
LAST = np.uint64(2**64 - 1)

FOUND = "kind int, doc_id bigint, row int, digest bigint, copy int, hash bigint, more int, place int, text string, n_words int, spans binary, sha string"
DONE = "doc_id bigint, row int, digest bigint, copy int, text string, n_words bigint, n_removed bigint, kept_sha256 string"


def chosen(grams: np.ndarray, whole: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The least phrase hash of every window, and for every phrase whether a window chooses it."""
    least = sliding(np.minimum, grams, span)
    bounded = np.where(whole, least, np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), bounded, np.zeros(span - 1, np.uint64)])
    return least, sliding(np.maximum, padded, span) == grams


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, blocks = byte_texts(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
        keys, owner = [], []
        for lo, hi in pieces(values):
            words = Words(values[lo:hi])
            if len(words.starts) < WINDOW:
                continue
            grams = gram_hashes(words.hashes(), PHRASE, 8)
            whole = inside(words.first, len(words.starts), WINDOW)
            _, picked = chosen(grams, whole, WINDOW - PHRASE + 1)
            at = np.flatnonzero(picked)
            doc = np.searchsorted(words.first, at, side="right") - 1
            keys.append(grams[at])
            owner.append(blocks[lo + doc])
        if not keys:
            continue
        hashes, owners = np.concatenate(keys), np.concatenate(owner)
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(hashes)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[at].view(np.int64)), pa.array(owners[at], pa.int32()), pa.array(counts, pa.int32())],
            ["hash", "block", "n"],
        )


class Automaton:
    """Phrases (tuples of words) as an automaton; a word is three letters, so that a node has few branches."""

    def __init__(self, phrases: list[tuple[bytes, ...]]):
        names = sorted({w for p in phrases for w in p})
        base = 2
        while base**3 < len(names) + 1:
            base += 1
        self.codes = {w: self._code(i + 1, base) for i, w in enumerate(names)}
        self.unknown = self._code(0, base)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in phrases:
            self.machine.add_word("".join([self.codes[w] for w in p]))
        if phrases:
            self.machine.make_automaton()
        self.empty = not phrases

    @staticmethod
    def _code(i: int, base: int) -> str:
        """Letters of three disjoint alphabets: a match can only begin at a word."""
        start = 0x4E00
        return chr(start + i // base**2) + chr(start + base + i // base % base) + chr(start + 2 * base + i % base)

    def ends(self, words: list[bytes]) -> list[int]:
        """Positions of the last words of all occurrences."""
        if self.empty:
            return []
        get, unknown = self.codes.get, self.unknown
        coded = "".join([get(w, unknown) for w in words])
        return [end // 3 for end, _ in self.machine.iter(coded)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of True, as pairs in one array."""
    return np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).astype(np.int32)


def _locate(docs: pa.Table, phrases: pa.Table) -> pa.Table:
    """Candidate windows of a block's documents, each window once at its first place, and the documents' rows."""
    order = sorted(
        zip(docs.column("doc_id").to_pylist(), byte_texts(docs.column("text").combine_chunks()), docs.column("digest").to_pylist()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0),
    )
    values = [text for _, text, _ in order]
    recurring = np.unique(phrases.column("hash").to_numpy().view(np.uint64))
    found: list[tuple] = []  # (lo, hi, words, grams, least, whole)
    patterns: dict[tuple, None] = {}
    for lo, hi in pieces(values):
        words = Words(values[lo:hi])
        if len(recurring) and len(words.starts) >= WINDOW:
            grams = gram_hashes(words.hashes(), PHRASE, 8)
            known = np.isin(grams, recurring) & inside(words.first, len(words.starts), PHRASE)
            if known.any():
                at = np.flatnonzero(known)
                at = at[np.unique(grams[at], return_index=True)[1]]
                raw = words.data.tobytes()
                for i in at:
                    patterns[tuple(raw[a:b] for a, b in zip(words.starts[i : i + PHRASE].tolist(), words.ends[i : i + PHRASE].tolist()))] = None
    machine = Automaton(list(patterns))
    del patterns
    rows: dict[str, list] = {k: [] for k in ("doc_id", "row", "digest", "copy", "text", "n_words", "spans", "sha")}
    win: dict[str, list] = {k: [] for k in ("doc_id", "row", "hash", "more", "place")}
    place, previous, number, copy = 0, None, 0, 0
    for lo, hi in pieces(values):
        words = Words(values[lo:hi])
        flags = np.zeros(len(words.starts), bool)  # phrases located
        split = [v.split() for v in values[lo:hi]]
        for k, tokens in enumerate(split):
            ends = machine.ends(tokens)
            if ends:
                flags[words.first[k] + np.array(ends) - (PHRASE - 1)] = True
        candidate = np.zeros(0, bool)
        if flags.any():
            hashes = words.hashes()
            grams = gram_hashes(hashes, PHRASE, 8)
            whole = inside(words.first, len(words.starts), WINDOW)
            span = WINDOW - PHRASE + 1
            least = sliding(np.minimum, grams, span)
            located = sliding(np.minimum, np.where(flags[: len(grams)], grams, LAST), span)
            candidate = whole & (located == least)
            window, second = gram_hashes(hashes, WINDOW, 20), gram_hashes(hashes, WINDOW, 1)
        for k in range(hi - lo):
            doc_id, text, digest = order[lo + k]
            if lo + k == 0 or doc_id != previous:
                place, number, copy = 0, 0, 0
            else:
                copy = copy + 1 if digest == order[lo + k - 1][2] else 0
            previous = doc_id
            a, b = int(words.first[k]), int(words.first[k + 1])
            own = candidate[a : max(a, b - WINDOW + 1)]
            rows["doc_id"].append(doc_id)
            rows["row"].append(number)
            rows["digest"].append(digest)
            rows["copy"].append(copy)
            rows["n_words"].append(b - a)
            if own.any():
                at = np.flatnonzero(own)
                win["doc_id"].append(np.full(len(at), -1 if doc_id is None else doc_id))
                win["row"].append(np.full(len(at), 1 if doc_id is None else 0, np.int32))
                win["hash"].append(window[a + at].view(np.int64))
                win["more"].append((second[a + at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                win["place"].append((place + at).astype(np.int32))
                rows["text"].append(text.decode("utf-8", "surrogatepass"))
                rows["spans"].append(np.append(_runs(own), np.int32(place)).tobytes())
                rows["sha"].append(None)
            else:
                rows["text"].append(None)
                rows["spans"].append(None)
                rows["sha"].append(hashlib.sha256(b" ".join(split[k])).hexdigest())
            place += b - a
            number += 1
    n = len(rows["doc_id"])
    out = pa.table({
        "kind": pa.array([0] * n, pa.int32()), "doc_id": pa.array(rows["doc_id"], pa.int64()), "row": pa.array(rows["row"], pa.int32()),
        "digest": pa.array(rows["digest"], pa.int64()), "copy": pa.array(rows["copy"], pa.int32()),
        "hash": pa.nulls(n, pa.int64()), "more": pa.nulls(n, pa.int32()), "place": pa.nulls(n, pa.int32()),
        "text": pa.array(rows["text"], pa.string()), "n_words": pa.array(rows["n_words"], pa.int32()),
        "spans": pa.array(rows["spans"], pa.binary()), "sha": pa.array(rows["sha"], pa.string()),
    })
    if not win["doc_id"]:
        return out
    part = {k: np.concatenate(v) for k, v in win.items()}
    nulls = part["row"] == 1  # a null id is earlier than any other
    order_by = np.lexsort((part["place"], part["doc_id"], ~nulls, part["more"], part["hash"]))
    part = {k: v[order_by] for k, v in part.items()}
    nulls = nulls[order_by]
    new = np.concatenate([[True], (part["hash"][1:] != part["hash"][:-1]) | (part["more"][1:] != part["more"][:-1])])
    m = int(new.sum())
    windows = pa.table({
        "kind": pa.array([1] * m, pa.int32()), "doc_id": pa.array(part["doc_id"][new], pa.int64(), mask=nulls[new]), "row": pa.nulls(m, pa.int32()),
        "digest": pa.nulls(m, pa.int64()), "copy": pa.nulls(m, pa.int32()),
        "hash": pa.array(part["hash"][new]), "more": pa.array(part["more"][new]), "place": pa.array(part["place"][new]),
        "text": pa.nulls(m, pa.string()), "n_words": pa.nulls(m, pa.int32()), "spans": pa.nulls(m, pa.binary()), "sha": pa.nulls(m, pa.string()),
    })
    return pa.concat_tables([out, windows])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the words of candidate windows that are not the earliest of their kind."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("text", "n_removed", "sha")}
        for text, spans, first in zip(byte_texts(batch.column("text")), batch.column("spans").to_pylist(), batch.column("first").to_pylist()):
            words = text.split()
            runs = np.frombuffer(spans, np.int32)
            base = int(runs[-1])
            late = np.zeros(len(words) + 1, np.int32)
            later = np.zeros(len(words), bool)
            for a, b in runs[:-1].reshape(-1, 2):
                later[a:b] = True
            if first:
                at = np.array(first, np.int64) - base
                later[at[(at >= 0) & (at < len(words))]] = False
            at = np.flatnonzero(later)
            np.add.at(late, at, 1)
            np.add.at(late, at + WINDOW, -1)
            kept = [w for w, gone in zip(words, np.cumsum(late[:-1]).tolist()) if not gone]
            joined = b" ".join(kept)
            out["n_removed"].append(len(words) - len(kept))
            out["sha"].append(hashlib.sha256(joined).hexdigest())
            out["text"].append(joined.decode("utf-8", "surrogatepass") if len(kept) < len(words) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), batch.column("digest"), batch.column("copy"), pa.array(out["text"], pa.string()), batch.column("n_words").cast(pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["sha"], pa.string())],
            ["doc_id", "row", "digest", "copy", "text", "n_words", "n_removed", "kept_sha256"],
        )


def text_digest(text: Column) -> Column:
    """A 64-bit hash of a text, null as empty; tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) without repeated passages.

    Returns doc_id, row (from 0 among the rows of one doc_id), digest (xxhash64 of the text), copy (from 0 among the rows of one doc_id and text), text (the kept words joined by one space; null where no word went), n_words, n_removed,
    kept_sha256; one row for each input row.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    base = docs.select(
        F.pmod(F.xxhash64(F.col("doc_id")), F.lit(blocks)).cast("int").alias("block"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("bigint").alias("doc_id"),
        text_digest(F.col("text")).alias("digest"),
    )
    phrases = base.select("block", "text").mapInArrow(_phrases, "hash bigint, block int, n int")
    recurring = (
        phrases.withColumn("total", F.sum("n").over(Window.partitionBy("hash"))).filter("total > 1").select("block", "hash")
    )
    found = base.groupBy("block").cogroup(recurring.groupBy("block")).applyInArrow(_locate, FOUND)
    found = written(found, "repeats")
    windows = found.filter("kind = 1").select("doc_id", "hash", "more", "place")
    first = (
        windows.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(2**63))))
        .groupBy("hash", "more")
        .agg(F.min("doc_id").alias("doc_id"), F.min_by("place", "doc_id").alias("place"))
        .groupBy("doc_id")
        .agg(F.collect_list("place").alias("first"))  # places of one document
        .withColumnRenamed("doc_id", "owner")
    )
    rows = found.filter("kind = 0")
    hit = rows.filter("spans is not null").withColumn("owner", F.coalesce("doc_id", F.lit(-(2**63))))
    changed = hit.join(first, "owner", "left").select("doc_id", "row", "digest", "copy", "text", "n_words", "spans", "first").mapInArrow(_remove, DONE)
    clean = rows.filter("spans is null").select(
        "doc_id", "row", "digest", "copy", F.lit(None).cast("string").alias("text"), F.col("n_words").cast("bigint"), F.lit(0).cast("bigint").alias("n_removed"), F.col("sha").alias("kept_sha256")
    )
    return clean.unionByName(changed)
