"""Token ids of whole texts, with the ids of words kept between texts.

The tokenizer drops white space between its words and its merges stay inside a word, so a text's ids are the ids of its
words in order, as separated by ASCII white space (``bytes.split()``). ``WordIds`` encodes a word once for many texts; ``check_words`` tells whether a
tokenizer is of that kind.
"""

from __future__ import annotations

import os
import string
from array import array
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
LONG_WORD = 64  # bytes; a longer word's ids are not kept
KEPT_WORDS, KEPT_STEMS = 200_000, 300_000  # entries of a generation of about 200 bytes each; a Python worker keeps two
_MARKS = string.punctuation.replace("<", "")

_OPEN: dict[str, "WordIds"] = {}


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


class Generations:
    """A bounded map of two generations: the young one turns old when full, and what is asked for again is young again."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def find(self, keys: list[bytes]) -> list[bytes | None]:
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        for i in [i for i, v in enumerate(found) if v is None] if old else ():
            value = old.get(keys[i])
            if value is not None:
                found[i] = young[keys[i]] = value
        return found

    def add(self, entries: Iterable[tuple[bytes, bytes]]) -> None:
        self.young.update(entries)

    def age(self) -> None:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young


def _plain(strings: pa.Array) -> list[bytes]:
    return strings.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat``, which have the given sizes, in the order of ``codes``, and where they begin and end."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.repeat(starts[codes] - ends[:-1], lengths) + np.arange(ends[-1])], ends


class WordIds:
    """Ids of texts as unsigned 32-bit integers, least byte first. ``stems`` keeps ids of lowered strings, ``known`` of others."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.stems = Generations(KEPT_WORDS), Generations(KEPT_STEMS)

    def _ids(self, kept: Generations, strings: list[bytes]) -> list[bytes]:
        """Ids of distinct strings."""
        found = kept.find(strings)
        new = [i for i, v in enumerate(found) if v is None]
        plain = [strings[i].decode("utf-8") for i in new]
        for i, e in zip(new, self.tokenizer.encode_batch_fast(plain, add_special_tokens=False)):
            found[i] = array("I", e.ids).tobytes()
        kept.add((strings[i], found[i]) for i in new if len(strings[i]) <= LONG_WORD)
        return found

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one word after another, and how many each has. Of a word without "<" (which may begin a special
        string) ASCII marks at the end, after an ASCII letter or digit, are set apart and ASCII letters are lowered: letters and
        marks are never in one token and the tokenizer folds case, so the ids are the same and fewer strings are encoded."""
        stems = pc.ascii_rtrim(words, characters=_MARKS)
        stems = pc.ascii_lower(pc.if_else(pc.match_substring_regex(stems, "[0-9A-Za-z]$"), stems, words))
        stems = pc.if_else(pc.match_substring(words, "<"), "", stems)
        lengths = pc.binary_length(stems).to_numpy()
        longer = np.flatnonzero(lengths < pc.binary_length(words).to_numpy())
        rest = [w[n:] for w, n in zip(_plain(words.take(pa.array(longer))), lengths[longer].tolist())]
        stems, rest = stems.dictionary_encode(), pa.array(rest, pa.binary()).dictionary_encode()
        found = [*self._ids(self.stems, _plain(stems.dictionary)), *self._ids(self.known, _plain(rest.dictionary)), b""]
        parts = np.full((len(words), 2), len(found) - 1)  # a stem and what follows it, or nothing
        parts[:, 0] = stems.indices.to_numpy()
        parts[longer, 1] = rest.indices.to_numpy() + len(stems.dictionary)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return _gathered(np.frombuffer(b"".join(found), "<u4"), sizes, parts.ravel())[0], sizes[parts].sum(axis=1)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, without added special tokens. Distinct words are looked up once for all texts."""
        self.known.age()
        self.stems.age()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = split.values.dictionary_encode()
        ids, ends = _gathered(*self._words(coded.dictionary), coded.indices.to_numpy())
        joined = ids.tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [joined[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


def opened(path: str) -> WordIds:
    """One encoder for each Python worker and file."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]


def release() -> None:
    """Forget the encoders, with the words they keep, that tasks of earlier steps left in this Python worker."""
    _OPEN.clear()
    pa.default_memory_pool().release_unused()


def check_words(path: str) -> None:
    """Raise unless the file's tokenizer drops white space and splits it off before merging."""
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if not (steps and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")) or spec.get("post_processor"):
        raise ValueError("ids of words can't be put together to ids of texts with this tokenizer")
