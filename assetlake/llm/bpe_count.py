"""Token counts by heap-and-linked-list byte-pair merging.

The merges, the alphabet and the special strings are read from a tokenizer file (byte-level pre-tokens with a suffix at
a word's end). A pre-token's symbols form a linked list; a heap has the ranks of adjacent pairs; the pair of lowest rank
(leftmost on ties) is popped and merged until none is left. The count is the symbols minus the merges; no id is made.
Counts of words are kept between texts, up to a bound, as most words come again.

Texts are normalised as the file says: NFC, white space, lower case by character. Special strings count one each.
Null and empty texts have no token.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts
from assetlake.llm.tokens import default_path

LIMIT = 2048
KEPT_WORDS, LONG_WORD = 800_000, 64
_SPACES = r"\t\n\x0b\f\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # white space of Unicode
COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones themselves, the others the next free from 256 on."""
    out, free = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            out.append(chr(byte))
        else:
            out.append(chr(free))
            free += 1
    return out


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of merges that byte-pair merging makes in a list of symbols."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    alive, merges = list(symbols), 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if alive[i] != left or j >= n or alive[j] != right:
            continue  # one of the two was merged meanwhile
        alive[i], alive[j] = left + right, ""
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((alive[i], alive[k]))) is not None:
                heapq.heappush(heap, (r, i, alive[i], alive[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((alive[h], alive[i]))) is not None:
            heapq.heappush(heap, (r, h, alive[h], alive[i]))
    return merges


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.vocabulary = set(model["vocab"])
        step = next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.words = regex.compile(step["pattern"]["Regex"].replace(r"\s", _SPACES))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.letters = byte_letters()
        self.known: dict[bytes, int] = {}
        self.tokens: dict[str, int] = {}

    def token(self, word: str) -> int:
        """Tokens of one pre-token."""
        found = self.tokens.get(word)
        if found is None:
            symbols = [self.letters[b] for b in word.encode("utf-8")]
            symbols[-1] += self.suffix
            symbols = [s for s in symbols if s in self.vocabulary]
            found = len(symbols) - merged(symbols, self.ranks)
            if len(word) <= LONG_WORD:
                self.tokens[word] = found
        return found

    def plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.token, self.words.findall(text)))

    def word(self, text: str) -> int:
        """Tokens of a text without ASCII white space."""
        if self.special is None or "<" not in text and not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1

    def count(self, text: bytes) -> int:
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        if len(self.tokens) > KEPT_WORDS:
            self.tokens = {}
        known, words = self.known, text.split()
        found = list(map(known.get, words))
        if None in found:
            for i, n in enumerate(found):
                if n is None:
                    word = words[i]
                    n = found[i] = known.get(word)
                    if n is None:
                        n = found[i] = self.word(word.decode("utf-8"))
                        if len(word) <= LONG_WORD:
                            known[word] = n
        return sum(found)


_OPEN: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit``) of every row of ``docs``."""
    file = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if file not in _OPEN:
            _OPEN[file] = Counter(file)
        counter = _OPEN[file]
        for batch in batches:
            values = byte_texts(batch.column(1))
            tokens = [counter.count(v) for v in values]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(v) for v in values], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, COUNTS)
