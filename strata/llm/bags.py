"""Words of whole texts, counted inside Arrow tasks.

Words are maximal runs of ASCII letters and digits and of bytes above 0x7F in the
UTF-8 text, with A-Z, and nothing else, lower-cased. A text is walked in pieces, so
that a very long one never stands in memory as one list of words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_word = re.compile(rb"[0-9a-z\x80-\xff]+")
_break = re.compile(rb"[^0-9a-z\x80-\xff]")

#: Bytes of a text that are cut into words at once.
PIECE = 1 << 22


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists; no word is cut."""
    raw = raw.lower()
    lo = 0
    while lo < len(raw):
        cut = _break.search(raw, lo + PIECE) if len(raw) - lo > PIECE else None
        hi = cut.start() if cut else len(raw)
        yield _word.findall(raw, lo, hi)
        lo = hi


def word_counts(raw: bytes) -> tuple[Counter, int]:
    """How often each word occurs, and the number of words."""
    counts: Counter = Counter()
    total = 0
    for words in pieces(raw):
        counts.update(words)
        total += len(words)
    return counts, total


def run_counts(raw: bytes, most: int) -> tuple[Counter, int, int]:
    """How often each run of 1 to ``most`` words, joined by a space, occurs; the number of runs; of words."""
    if most == 1:
        counts, total = word_counts(raw)
        return counts, total, total
    counts = Counter()
    runs = total = 0
    carried: list[bytes] = []
    for new in pieces(raw):
        words = carried + new
        for n in range(1, most + 1):
            first = max(0, len(carried) - n + 1)  # runs that end in the new words
            found = [b" ".join(words[i : i + n]) for i in range(first, len(words) - n + 1)]
            counts.update(found)
            runs += len(found)
        total += len(new)
        carried = words[max(0, len(words) - most + 1) :]
    return counts, runs, total


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; null is the empty text."""
    return column.fill_null("").cast(pa.large_binary()).to_pylist()


def lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets (from 0) and values of a list column without nulls."""
    at = np.asarray(column.offsets, dtype=np.int64)
    return at - at[0], np.asarray(column.values)[at[0] : at[-1]]
