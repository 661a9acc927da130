"""Token counts by rank-synchronous merging of ragged arrays.

All pre-tokens of a batch that weren't seen before lie end to end in one array
of symbols. In each round every sequence applies its own lowest-ranked pair, at
all places at once (of overlapping places the leftmost, then every second one);
then the array is closed up and only pairs beside a merge are looked up again.
When no sequence has a pair left, the symbols that survive are its tokens.

All places at once gives what one merge at a time gives, because a pair with a
merged symbol always ranks after the merge that makes the symbol.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import textops
from strata.llm.tables import small_batches, text_of

_NONE = np.int64(2**31 - 1)
REMEMBERED = 1_000_000


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it prints, else the next from U+0100 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """The merges of a tokenizer file: symbols, and of each pair its rank and the symbol it makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError(f"{path}: not a byte-level BPE without a normalizer")
        vocab = model["vocab"]
        letters = _byte_letters()
        self.byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.keys, self.rank = key[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # one lookup table less: ranks are places in the list of merges
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)


@functools.lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def count_pieces(pieces: list[bytes], m: Merges) -> np.ndarray:
    """Tokens of every pre-token."""
    counts = np.array([len(p) for p in pieces], np.int64)
    of = np.repeat(np.arange(len(pieces)), counts)
    symbol = m.byte[np.frombuffer(b"".join(pieces), np.uint8)]

    def looked_up(where: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that start there; a sequence's last symbol starts none."""
        nxt = np.minimum(where + 1, len(symbol) - 1)
        inside = (where + 1 < len(symbol)) & (of[nxt] == of[where])
        return np.where(inside, m.of_pairs(symbol[where], symbol[nxt]), _NONE)

    rank = looked_up(np.arange(len(symbol)))
    while len(symbol):
        heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sizes = np.diff(np.append(heads, len(of)))
        low = np.minimum.reduceat(rank, heads)
        stay = low != _NONE
        if not stay.any():
            break
        if not stay.all():  # finished sequences leave
            keep = np.repeat(stay, sizes)
            symbol, of, rank = symbol[keep], of[keep], rank[keep]
            low, sizes = low[stay], sizes[stay]
        hit = np.flatnonzero(rank == np.repeat(low, sizes))
        follows = np.concatenate([[False], (hit[1:] == hit[:-1] + 1) & (of[hit[1:]] == of[hit[:-1]])])
        if follows.any():  # a run of overlapping places: every second one, from the left
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(hit))))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        symbol[hit] = m.made[rank[hit]]
        np.subtract.at(counts, of[hit], 1)
        gone = np.zeros(len(symbol), bool)
        gone[hit + 1] = True
        place = np.cumsum(~gone) - 1
        symbol, of, rank = symbol[~gone], of[~gone], rank[~gone]
        changed = place[hit]
        near = np.unique(np.concatenate([changed, np.maximum(changed - 1, 0)]))
        rank[near] = looked_up(near)
    return counts


class Counter:
    """Counts tokens of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str):
        self.merges = merges(path)
        self.forget()

    def forget(self) -> None:
        self.known = textops.Known()
        self.counts = np.zeros(0, np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        plain, of_plain = texts, np.arange(len(texts))
        for special in self.merges.special:  # a special string is one token and parts the text
            if any(special in t for t in plain):
                parts = [t.split(special) for t in plain]
                np.add.at(total, of_plain, [len(p) - 1 for p in parts])
                of_plain = np.repeat(of_plain, [len(p) for p in parts])
                plain = [x for p in parts for x in p]
        for part, of in textops.grouped(plain):
            joined, starts, ends, first = textops.pretokens(part)
            if len(self.counts) > REMEMBERED:
                self.forget()
            numbers, new = self.known.look_up(joined, starts, ends)
            if new:
                pieces = [x.encode() for x in new]
                got = [count_pieces(pieces[lo : lo + (1 << 15)], self.merges) for lo in range(0, len(new), 1 << 15)]
                self.counts = np.concatenate([self.counts, *got])
            each = self.counts[numbers]
            sums = np.concatenate([[0], np.cumsum(each)])
            np.add.at(total, of_plain[of], sums[first[1:]] - sums[first[:-1]])
        return total


def count_batches(path: str):
    """For mapInArrow: replaces the last column, the text, by its size in bytes and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            size = np.diff(textops.utf8(column)[1])
            counts = np.concatenate([np.zeros(0, np.int64), *(counter.count([t or "" for t in column[rows].to_pylist()]) for rows in textops.slices(column))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(size, pa.int64()), pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than ``limit`` tokens.

    Special strings inside a text count as one token, as the library has it by
    default. A null text counts as empty: 0 and 0. Rows are independent: null or
    repeated ids pass through, further columns are not read, an empty table
    gives no rows. No shuffle.
    """
    small_batches(docs.sparkSession)
    part = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = part.mapInArrow(count_batches(path), f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", out.n_tokens > limit).withColumnRenamed("id", id_col)
