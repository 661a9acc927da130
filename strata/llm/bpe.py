"""Byte-level BPE encoding and decoding.

Each pre-token keeps a segment tree over its byte positions. A leaf holds the
rank of the pair that starts at that live position (joined with the position,
so that ties go to the leftmost); the root is the next merge. A merge changes
three leaves (the pair itself, its left neighbour, the position that dies), each
a logarithmic update. Pre-tokens of up to 64 bytes run side by side in numpy,
one tree per row; longer ones run one at a time, in O(n log n).

Vocabulary files are read by path inside the tasks; nothing is broadcast.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import textops
from strata.llm.tables import small_batches, text_of

_NONE = np.int32(2**31 - 1)
#: Pre-tokens whose ids a task remembers; beyond that it starts over.
REMEMBERED = 1_000_000


class Ranks:
    """A rank file: token bytes by id, and the rank of every pair that joins to a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            (self.rank[t[:i]] << 32) | self.rank[t[i:]]: r
            for t, r in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        }
        self.pair = pairs
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.fromiter(pairs.values(), np.int32, len(pairs))[order]
        self.text = [str(i) for i in range(len(self.token))]

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of joined pairs, -1 where there is none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1)


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def encode_long(piece: bytes, r: Ranks) -> list[int]:
    """One pre-token with its own tree."""
    n = len(piece)
    size = 1 << max(1, (n - 1).bit_length())
    none = 1 << 62
    ids = [int(r.byte[b]) for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * size)

    def value(i: int) -> int:
        rank = r.pair.get((ids[i] << 32) | ids[after[i]]) if after[i] < n else None
        return none if rank is None else rank * size + i

    for i in range(n - 1):
        tree[size + i] = value(i)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    alive = bytearray(b"\1") * n
    while tree[1] != none:
        rank, i = divmod(tree[1], size)
        gone = after[i]
        ids[i], alive[gone], after[i] = rank, 0, after[gone]
        if after[i] < n:
            before[after[i]] = i
        for leaf, new in ((gone, none), (i, value(i)), *(((before[i], value(before[i])),) if before[i] >= 0 else ())):
            node = size + leaf
            tree[node] = new
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
    return [x for x, live in zip(ids, alive, strict=True) if live]


def _encode_rows(pieces: list[bytes], size: int, r: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens of 2 to ``size`` bytes, one tree per row: ids row by row, and counts."""
    rows, bits = len(pieces), size.bit_length() - 1
    length = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
    ids = np.zeros((rows, size + 1), np.int32)
    ids[:, :size] = r.byte[raw]
    place = np.arange(size + 1, dtype=np.int16)
    after = np.repeat((place + 1)[None], rows, 0)
    before = np.repeat((place - 1)[None], rows, 0)
    alive = place[None, :size] < length[:, None]
    tree = np.full((rows, 2 * size), _NONE, np.int32)
    pair = r.of_pairs(ids[:, : size - 1], ids[:, 1:size])
    fits = (pair >= 0) & (place[None, 1:size] < length[:, None])
    tree[:, size : 2 * size - 1] = np.where(fits, (pair << bits) | place[None, : size - 1], _NONE)
    node = size >> 1
    while node:
        tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
        node >>= 1
    row = np.flatnonzero(tree[:, 1] != _NONE)
    while len(row):
        top = tree[row, 1]
        rank, i = top >> bits, top & (size - 1)
        gone = after[row, i]
        new_after = after[row, gone]
        ids[row, i] = rank
        after[row, i] = new_after
        alive[row, gone] = False
        inside = new_after < length[row]
        before[row, np.where(inside, new_after, size)] = np.where(inside, i, 0)
        left = before[row, i]
        has_left = left >= 0
        left = np.where(has_left, left, i)
        right_rank = np.where(inside, r.of_pairs(rank, ids[row, np.where(inside, new_after, 0)]), -1)
        own = np.where(right_rank >= 0, (right_rank << bits) | i, _NONE)
        left_rank = np.where(has_left, r.of_pairs(ids[row, left], rank), -1)
        others = np.where(left_rank >= 0, (left_rank << bits) | left, _NONE)
        tree[row, size + gone] = _NONE
        tree[row, size + left] = others
        tree[row, size + i] = own
        for leaf in (gone, left, i):
            node = (size + leaf) >> 1
            while node[0]:
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                node = node >> 1
        row = row[tree[row, 1] != _NONE]
    return ids[:, :size][alive], alive.sum(1)


def encode_pieces(pieces: list[bytes], r: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens laid end to end, and the number of each. One that is itself a token is that token."""
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    token = np.fromiter((r.rank.get(p, -1) for p in pieces), np.int64, len(pieces))
    done = [(np.flatnonzero(token >= 0), token[token >= 0], np.ones(int((token >= 0).sum()), np.int64))]
    rest = token < 0
    for size in (2, 4, 8, 16, 32, 64):
        some = np.flatnonzero(rest & (length <= size) & (length > size // 2))
        for lo in range(0, len(some), 16384):
            part = some[lo : lo + 16384]
            done.append((part, *_encode_rows([pieces[k] for k in part], size, r)))
    for k in np.flatnonzero(rest & (length > 64)).tolist():
        ids = np.array(encode_long(pieces[k], r))
        done.append((np.array([k]), ids, np.array([len(ids)])))
    counts = np.zeros(len(pieces), np.int64)
    for which, _, n in done:
        counts[which] = n
    first = np.cumsum(counts) - counts
    flat = np.zeros(int(counts.sum()), np.int32)
    for which, ids, n in done:
        flat[np.repeat(first[which] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
    return flat, counts


class Encoder:
    """Encodes texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str):
        self.ranks = ranks(path)
        self.forget()

    def forget(self) -> None:
        self.known = textops.Known()
        self.flat = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 16, np.int64)
        self.learnt = 0

    def _learn(self, pieces: list[bytes]) -> None:
        """The next numbers' ids."""
        ids, counts = encode_pieces(pieces, self.ranks)
        k, m = self.learnt, len(pieces)
        while k + m + 1 > len(self.at):
            self.at = np.append(self.at, np.zeros(len(self.at), np.int64))
        lo = self.at[k]
        while lo + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros(len(self.flat), np.int32))
        self.flat[lo : lo + len(ids)] = ids
        self.at[k + 1 : k + m + 1] = lo + np.cumsum(counts)
        self.learnt += m

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and the number of each text."""
        out, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for part, of in textops.grouped(texts):
            joined, starts, ends, first = textops.pretokens(part)
            if self.learnt > REMEMBERED:
                self.forget()
            places, new = self.known.look_up(joined, starts, ends)
            if new:
                self._learn([x.encode() for x in new])
            lo, n = self.at[places], self.at[places + 1] - self.at[places]
            if not len(n):
                continue
            upto = np.cumsum(n)
            out.append(self.flat[np.repeat(lo - upto + n, n) + np.arange(upto[-1])])
            sums = np.concatenate([[0], upto])
            np.add.at(counts, of, sums[first[1:]] - sums[first[:-1]])
        return np.concatenate(out), counts

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.ranks.token.__getitem__, ids.tolist()))


def encode_batches(path: str, ids: bool):
    """For mapInArrow: replaces the last column, the text, by what its ids give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for rows in textops.slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                flat, counts = encoder.encode([t or "" for t in part.column(part.num_columns - 1).to_pylist()])
                shas, decoded, lists = [], [], []
                for own in np.split(flat, np.cumsum(counts)[:-1]):
                    shas.append(hashlib.sha256(" ".join(map(encoder.ranks.text.__getitem__, own.tolist())).encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(own)).hexdigest())
                    if ids:
                        lists.append(own)
                columns = [*part.columns[:-1], pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded)]
                names = [*part.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids again.

    Returns one row per input row: ``id_col``, ``n_tokens``, ``ids_sha256`` (of
    the decimal ids joined by one space), ``decoded_sha256`` and with ``ids``
    the ids themselves. A null text counts as empty: no ids, and the digests of
    nothing. Rows are independent: null or repeated ids pass through, further
    columns are not read, an empty table gives no rows. No shuffle.
    """
    small_batches(docs.sparkSession)
    part = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return part.mapInArrow(encode_batches(path, ids), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Texts of lists of ids: all columns of ``encoded`` with ``ids_col`` replaced by ``text``.

    Bytes that are no UTF-8 (a list cut inside a character) become U+FFFD; a
    null list gives a null text; an id outside the vocabulary fails the job.
    """
    names = [c for c in encoded.columns if c != ids_col]
    part = encoded.select(*names, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = ranks(path).token
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            if any(i < 0 for x in lists if x for i in x):
                raise ValueError("negative token id")
            texts = [None if x is None else b"".join(token[i] for i in x).decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema.fields[:-1])
    return part.mapInArrow(run, (fields + ", " if fields else "") + "text string")
