"""Lower-cased terms of whole texts, as bytes, and batches of documents as one string.

A term is a run of ASCII digits, ASCII letters and characters beyond ASCII; only A-Z are lower-cased. In UTF-8 every byte
of a character beyond ASCII is 0x80 or more, so the classes hold for bytes.
"""

from __future__ import annotations

import re

import numpy as np

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SENTINEL = b"\x00"  # no term byte: it ends the last term of a document
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """All terms of a text, in order."""
    return TERM.findall(text.translate(_LOWER))


def batch_terms(values: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Terms of several texts by one pass over their concatenation, and the text each of them stands in."""
    data = SENTINEL.join(values).translate(_LOWER)
    found, starts = [], []
    for match in TERM.finditer(data):
        found.append(match.group())
        starts.append(match.start())
    offsets = np.zeros(len(values), np.int64)
    np.cumsum([len(v) + 1 for v in values[:-1]], out=offsets[1:])
    return found, np.searchsorted(offsets, np.array(starts, np.int64), side="right") - 1
