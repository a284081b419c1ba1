"""Arrow batches as text: pieces of bounded size, word positions and polynomial hashes with numpy.

A word is a run of bytes other than space and the control characters 0x09 to 0x0D, as ``bytes.split()`` has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20  # numpy works on about so much text at once; a longer document makes a piece of its own
_STEP, _KEPT = 1 << 16, 2 * PIECE_BYTES  # tables of powers grow by steps; a table beyond the bound serves one document

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MULTIPLIER = {8: 0x9E3779B97F4A7C15, 20: 0xD6E8FEB86659FD93, 0: 0xC2B2AE3D27D4EB4F, 1: 0xA0761D6478BD642F}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def texts(column: pa.Array) -> list[str]:
    """Python strings of a column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of a column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(values: list[bytes], size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents whose texts together have about ``size`` bytes."""
    start = total = 0
    for i, value in enumerate(values):
        if i > start and total + len(value) > size:
            yield start, i
            start, total = i, 0
        total += len(value)
    if start < len(values):
        yield start, len(values)


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier modulo 2**64 and of its inverse."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        size = -(-n // _STEP) * _STEP
        out = []
        for base in (_MULTIPLIER[seed], pow(_MULTIPLIER[seed], -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            out.append(np.multiply.accumulate(factors))
        have = (out[0], out[1])
        if size <= _KEPT:
            _POWERS[seed] = have
    return have


def release_powers() -> None:
    """Forget the tables of powers that tasks of earlier steps left in this Python worker."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Words:
    """Word positions and word hashes of several texts; ``first`` has each text's first word and the end."""

    def __init__(self, values: list[bytes], seed: int = 0):
        self.data = np.frombuffer(b" ".join(values) + b" ", np.uint8)
        word = ~_SPACE[self.data]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        offsets = np.zeros(len(values) + 1, np.int64)
        np.cumsum([len(v) + 1 for v in values], out=offsets[1:])
        self.offsets = offsets
        self.first = np.searchsorted(self.starts, offsets)
        self.seed = seed

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        power, inverse = _powers(self.seed, len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])


def gram_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of every run of n words, also those that cross texts; empty if there are fewer words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(seed, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[: len(words) - n + 1])


def inside(first: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """For every run of n words, whether it lies in one text."""
    ok = np.zeros(max(0, n_words - n + 1), bool)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            ok[a : b - n + 1] = True
    return ok


def sliding(op, values: np.ndarray, width: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over every run of ``width`` values."""
    out, span = values, 1
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[:-rest], out[rest:]) if rest else out
