"""Vectorised text primitives that run inside Arrow tasks.

Texts of a batch are laid end to end in one array, so that a handful of numpy
passes replaces a Python step per character. The hash of a slice is the sum of its
symbols times an odd random number for each place in the slice: places have
numbers of their own, so no pattern of symbols makes sums meet as the powers of
one number do. ``rolling_hashes`` is a sum of such powers, for slices that overlap;
use it only where equal hashes are compared afterwards.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

#: Code units in one numpy pass; longer texts are cut at places that change nothing.
BLOCK = 1 << 20
_P = 0x9E3779B97F4A7C15  # odd
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i below at least ``n``."""
    global _powers
    if len(_powers[0]) < n:
        size = -(-n // BLOCK) * BLOCK
        up, down = np.full(size, _P, _U), np.full(size, pow(_P, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size > 8 * BLOCK:  # not kept for the sake of one long word
            out, _powers = _powers, (np.ones(1, _U), np.ones(1, _U))
            return out
    return _powers


def rolling_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of overlapping ``codes[starts[i]:ends[i]]`` from prefix sums; unequal slices of some patterns collide."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


_places: dict[int, np.ndarray] = {}


def _place_numbers(n: int, seed: int) -> np.ndarray:
    """Odd random numbers for the places 0 to n - 1 at least."""
    known = _places.get(seed, np.zeros(0, _U))
    if len(known) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        known = mix(np.arange(1, size + 1, dtype=_U) * _U(_P) + _U(seed) * _U(0xD6E8FEB86659FD93)) | _U(1)
        if size <= BLOCK:  # not kept for the sake of one long slice
            _places[seed] = known
    return known


def slice_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of ``codes[starts[i]:ends[i]]``, slices that don't overlap; ``codes`` are mixed symbols."""
    sizes = ends - starts
    out = np.zeros(len(starts), _U)
    if not len(starts):
        return out
    some = np.flatnonzero(sizes)
    if len(some):
        size = sizes[some]
        upto = np.cumsum(size)
        place = np.arange(upto[-1]) - np.repeat(upto - size, size)
        which = place + np.repeat(starts[some], size)
        terms = codes[which] * _place_numbers(int(size.max()), seed)[place]
        out[some] = np.add.reduceat(terms, upto - size)
    return mix(out + sizes.astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column laid end to end, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = 4 * BLOCK) -> Iterator[slice]:
    """Row ranges of a batch with about ``limit`` bytes each (one row at least)."""
    _, at = utf8(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield slice(row, end)
        row = end


# -- words -------------------------------------------------------------------

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 0x20
_alnum = np.zeros(256, bool)
_alnum[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_byte_code = mix(np.arange(1, 257, dtype=_U))


def word_hashes(column: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every row with A-Z lower-cased, and the rows' offsets.

    Words are maximal runs without the bytes 0x20 and 0x09-0x0D; with
    ``letters_only`` they are maximal runs of ASCII letters, digits and bytes
    above 0x7F, so that punctuation doesn't matter.
    """
    raw, at = utf8(column)
    breaks = ~_alnum if letters_only else _space
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[at] = True
    hashes, where = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    lo = 0
    while lo < n:
        hi = min(n, lo + BLOCK)
        while hi < n and not first[hi]:  # to the next break, so that no word is cut
            ahead = np.flatnonzero(breaks[raw[hi : hi + 4096]] | first[hi : min(n, hi + 4096)])
            if len(ahead):
                hi += int(ahead[0])
                break
            hi = min(n, hi + 4096)
        part = raw[lo:hi]
        word = ~breaks[part]
        head = np.empty(hi - lo, bool)
        head[0] = True
        head[1:] = ~word[:-1]
        head |= first[lo:hi]
        head &= word
        tail = np.empty(hi - lo, bool)
        tail[-1] = True
        tail[:-1] = ~word[1:]
        tail[:-1] |= first[lo + 1 : hi]
        tail &= word
        starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        hashes.append(slice_hashes(_byte_code[_lower[part]], starts, ends))
        where.append(starts + lo)
        lo = hi
    return np.concatenate(hashes), np.searchsorted(np.concatenate(where), at)


_gram_odd = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (none if there are fewer)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, _U)
    out = np.full(size, n, _U)
    for j in range(n):
        out += words[j : j + size] * _gram_odd[j % 64]
    return mix(out)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``n`` words; fewer words are one shingle, none the empty set."""
    if len(words) >= n:
        return np.unique(gram_hashes(words, n))
    return gram_hashes(words, len(words)) if len(words) else np.zeros(0, _U)


# -- pre-tokens ----------------------------------------------------------------


@functools.cache
def _classes() -> np.ndarray:
    """Of every code point: 1 letter, 2 number, 3 white space, 0 other."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    shift = 0xE000 - 0xD800
    for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            for point in range(m.start(), m.end()):
                out[point + (shift if point >= 0xD800 else 0)] = kind
    return out


@functools.cache
def _point_codes() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=_U))


def pretokens(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Matches of the tokenizers' pattern: the joined text, starts, ends and each text's first match.

    The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Its matches tile the text, so only the
    starts are needed: a change of class starts a match unless one space (0x20)
    before it already did; of white space, the run's first and last character
    start one, the last not at the end of the text; a contraction ends early.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(points)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    if not n:
        return joined, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    first = np.zeros(n + 1, bool)
    first[at] = True
    kind = _classes()[points]
    space = kind == 3
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= first[:n]
    start = change.copy()
    start[1:] &= first[1:n] | space[1:] | (points[:-1] != 0x20)
    last = space.copy()  # last of a run, not at the end of its text
    last[:-1] &= ~space[1:]
    last &= ~first[1:]
    start |= last
    quotes = np.flatnonzero(start & (points == 0x27))
    if len(quotes):
        end = at[np.searchsorted(at, quotes, "right")]
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        one = np.where(quotes + 1 < end, padded[quotes + 1], 0)
        two = np.where(quotes + 2 < end, padded[quotes + 2], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for which, size in ((short, 2), (long, 3)):
            q = quotes[which]
            start[q + 1] = False
            after = q + size
            start[after[after < end[which]]] = True
    starts = np.flatnonzero(start)
    return joined, starts, np.append(starts[1:], n), np.searchsorted(starts, at)


class Known:
    """Pre-tokens that a task has met, numbered; each is told from others with its key by its text."""

    def __init__(self):
        self.numbers: dict[int, int] = {}  # of the first pre-token with a key
        self.pieces: list[str] = []
        self.others: dict[str, int] = {}  # of pre-tokens that met another one's key

    def look_up(self, joined: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """The number of every pre-token, and those that are new, in the order of their numbers."""
        if not len(starts):
            return np.zeros(0, np.int64), []
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        keys = slice_hashes(_point_codes()[points], starts, ends)
        distinct, some, which = np.unique(keys, return_index=True, return_inverse=True)
        before = len(self.pieces)
        found = np.empty(len(distinct), np.int64)
        for i, (key, k) in enumerate(zip(distinct.tolist(), some.tolist(), strict=True)):
            piece = joined[starts[k] : ends[k]]
            number = self.numbers.setdefault(key, len(self.pieces))
            if number == len(self.pieces):
                self.pieces.append(piece)
            elif self.pieces[number] != piece:
                number = self._other(piece)
            found[i] = number
        out = found[which]
        first = some[which]  # the others of a key against its first: sizes, then all symbols
        sizes = ends - starts
        odd = sizes != sizes[first]
        rest = np.flatnonzero(~odd & (first != np.arange(len(starts))))
        size = sizes[rest]
        upto = np.cumsum(size)
        place = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - size, size)
        differ = points[place + np.repeat(starts[rest], size)] != points[place + np.repeat(starts[first[rest]], size)]
        odd[rest[np.repeat(np.arange(len(rest)), size)[differ]]] = True
        for k in np.flatnonzero(odd).tolist():
            out[k] = self._other(joined[starts[k] : ends[k]])
        return out, self.pieces[before:]

    def _other(self, piece: str) -> int:
        number = self.others.setdefault(piece, len(self.pieces))
        if number == len(self.pieces):
            self.pieces.append(piece)
        return number


_cut = regex.compile(r"(?<=[^\p{White_Space}]) (?=[^\p{White_Space}])")


def chunks(text: str, limit: int = BLOCK) -> list[str]:
    """A long text cut before single spaces, where a match always starts."""
    out, lo = [], 0
    while len(text) - lo > limit and (m := _cut.search(text, lo + limit)):
        out.append(text[lo : m.start()])
        lo = m.start()
    return [*out, text[lo:]]


def grouped(texts: list[str], limit: int = BLOCK) -> Iterator[tuple[list[str], np.ndarray]]:
    """Chunks of texts in groups of about ``limit`` characters, with the text each chunk is of."""
    part, of, size = [], [], 0
    for i, text in enumerate(texts):
        for chunk in chunks(text, limit):
            if part and size + len(chunk) > limit:
                yield part, np.array(of)
                part, of, size = [], [], 0
            part.append(chunk)
            of.append(i)
            size += len(chunk)
    if part:
        yield part, np.array(of)
