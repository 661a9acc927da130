"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of words; its hash takes the words at the
mask's ones only, so it survives a substitution at any of its zeros. Hashes of
every position of the documents and of the benchmark meet in a join; each hit
fixes an item and an offset, and around it the aligned words are compared. Short
items get seeds of their own, which leave out the words that may be replaced.

A fixed-size bit map of the benchmark's hashes goes to all tasks, so that only
documents with a possible hit leave the scan. Its size doesn't depend on either
table; a larger benchmark only lets more documents through to the exact join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.tables import fresh, small_batches, staged, text_of

#: Masks of weight 5; together they hit every run of 12 words in which every sixth word is replaced.
MASKS = ("11111", "1101011", "110010011")
#: 2**MAP_BITS bits, 8 MB.
MAP_BITS = 26
#: Agreeing words from which a stretch counts though most of the item isn't there.
ALONE = 4


#: Longest items whose replaced words are listed one by one; longer ones that keep 80 % always hold a mask.
LISTED = 10


def _shapes(short: list[int], share: float = 0.8) -> list[tuple[int, np.ndarray]]:
    """(number, places of its ones) of every mask, and of what items of these few words need besides.

    An item of n words needs, for every way to replace as many as it may lose
    that no mask survives, the words that are left. The numbers of such shapes
    are ``1000 * n`` and more.
    """
    masks = [(k, np.flatnonzero([c == "1" for c in m])) for k, m in enumerate(MASKS)]
    out = list(masks)
    for n in short:
        number = 1000 * n
        for gone in itertools.combinations(range(n), math.floor(n * (1 - share) + 1e-9)):
            left = set(range(n)).difference(gone)
            if left and not any(left.issuperset((ones + at).tolist()) for _, ones in masks for at in range(n - int(ones[-1]))):
                out.append((number, np.array(sorted(left))))
                number += 1
    return out


_odd = textops.mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)


def _seeds(words: np.ndarray, places: np.ndarray, kind: int) -> np.ndarray:
    size = len(words) - int(places[-1])
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(size, kind + 1, np.uint64)
    for j, place in enumerate(places):
        out += words[place : place + size] * _odd[j]
    return textops.mix(out)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of the last column's texts, punctuation and case aside."""
    import pyarrow.compute as pc

    column = pc.utf8_lower(batch.column(batch.num_columns - 1).fill_null(""))
    for rows in textops.slices(column):
        words, at = textops.word_hashes(column[rows], letters_only=True)
        for i, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
            yield rows.start + i, words[lo:hi]


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [w.view(np.int64) for _, w in _rows(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "item_words"])


def _seed_batches(shapes):
    """For mapInArrow over (item, item_words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, places, hashes = [], [], []
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.array(words, np.int64).view(np.uint64)
                for kind, ones in shapes:
                    if kind < 1000 or kind // 1000 == len(words):
                        got = _seeds(words, ones, kind)
                        items += [item] * len(got)
                        places += range(len(got))
                        hashes += got.view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(places, pa.int32()), pa.array(hashes, pa.int64())], names=["item", "at", "seed"])

    return run


def _scan_batches(shapes, bits):
    """For mapInArrow over (doc_id, key, text): documents with seeds in the bit map, with their words and those seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        low, high = np.uint64((1 << MAP_BITS) - 1), np.uint64(64 - MAP_BITS)

        def marked(x: np.ndarray) -> np.ndarray:
            return (table[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            rows, all_words, places, seeds = [], [], [], []
            for row, words in _rows(batch):
                at, hashes = [], []
                for kind, ones in shapes:
                    got = _seeds(words, ones, kind)
                    some = np.flatnonzero(marked(got & low))
                    some = some[marked(got[some] >> high)]
                    at.append(some)
                    hashes.append(got[some])
                if any(map(len, at)):
                    rows.append(row)
                    all_words.append(words.view(np.int64))
                    places.append(np.concatenate(at).astype(np.int32))
                    seeds.append(np.concatenate(hashes).view(np.int64))
            keep = batch.take(pa.array(rows, pa.int64()))
            ints = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*keep.columns[:2], pa.array(all_words, ints), pa.array(places, pa.list_(pa.int32())), pa.array(seeds, ints)], names=["doc_id", "key", "words", "at", "seed"])

    return run


def _stretches(same: np.ndarray, share: float) -> np.ndarray:
    """Agreeing words in any stretch in which at least ``share`` of the words agree, ``ALONE`` words or more.

    With a score of 1 for a word that agrees and one that makes up for it at
    ``share``, these are the stretches with a sum of 0 or more; of those that begin
    at one word the longest holds all others.
    """
    n = len(same)
    sums = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - share, -share))])
    count = np.concatenate([[0], np.cumsum(same)])
    ahead = np.maximum.accumulate(sums[::-1])  # the highest sum from each place on, last place first
    stop = n - np.searchsorted(ahead, sums[:-1] - 1e-9)
    begin = np.flatnonzero(count[stop] - count[:-1] >= ALONE)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, stop[begin], -1)
    return same & (np.cumsum(change)[:-1] > 0)


def _along(group: list[np.ndarray]) -> int:
    """Most words that agree on a way along the item that changes between offsets, to higher and to lower ones."""
    most = np.zeros(len(group[0]) + 1, np.int64)
    for same in [*group, *group[::-1], *group] if len(group) > 1 else group:
        sums = np.concatenate([[0], np.cumsum(same)])
        most = sums + np.maximum.accumulate(most - sums)
    return int(most[-1])


def overlap(words: np.ndarray, item: np.ndarray, offsets: list[int], share: float) -> int:
    """Words of the item found in the document around hits at these offsets.

    Offsets that lie close together are one place, in which words may have been
    inserted or left out. If ``share`` of the item agrees along one place, all
    words that agree there count, wherever they stand. Else it holds a part of the
    item, and the words in stretches in which at least ``share`` agree count;
    single ones among others don't, since in a long item they agree by chance. The
    largest sum over one place counts.
    """
    offsets = sorted(offsets)
    agree, covered = [], []
    for offset in offsets:
        lo, hi = max(0, -offset), min(len(item), len(words) - offset)
        same = np.zeros(len(item), bool)
        same[lo:hi] = words[lo + offset : hi + offset] == item[lo:hi]
        agree.append(same)
        covered.append(_stretches(same, share))
    most = 0
    near = len(item) // 4 + 2
    for i, offset in enumerate(offsets):
        some, any_of, end = covered[i], agree[i], i + 1
        while end < len(offsets) and offsets[end] - offset <= near:
            some, any_of = some | covered[end], any_of | agree[end]
            end += 1
        most = max(most, int(some.sum()))
        every = int(any_of.sum())
        if every > most and every >= share * len(item) and (found := _along(agree[i:end])) >= share * len(item):
            most = max(most, found)
    return most


def _verify_batches(share: float):
    """For mapInArrow over (doc_id, key, item, words, item_words, offsets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, size = [], []
            for words, item, offsets in zip(*(batch.column(k) for k in (3, 4, 5)), strict=True):
                item = item.values.to_numpy(zero_copy_only=False)
                same.append(overlap(words.values.to_numpy(zero_copy_only=False), item, offsets.as_py(), share))
                size.append(len(item))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(same, pa.int64()), pa.array(size, pa.int64())], names=["doc_id", "key", "item", "n_matched", "n_item_words"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, least: int = 20, id_col: str = "doc_id", text_col: str = "text", min_item_words: int = 1) -> DataFrame:
    """Documents that hold a benchmark item, with up to ``1 - share`` of its words replaced.

    Words are runs of letters and digits, lower-cased. A document leaks an item
    if ``share`` of the item's words are found around a hit, or ``least`` words
    of a longer item; items of fewer than ``min_item_words`` words aren't looked
    for. Returns one row per leak: ``doc_id``, ``key`` (a hash of the text),
    ``item_id``, ``n_matched``, ``n_item_words``. Items with the same words are
    searched for and compared once, and each of their ids gets its row. Empty or
    null texts, and items without words, leak nothing; repeated rows leak alike
    and give one row; items with a null id are compared as well. Further columns
    aren't read; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    items = items.mapInArrow(_item_batches, "item_id long, item_words array<long>").where(F.size("item_words") >= max(1, min_item_words))
    named = staged(items.distinct(), "named-items")
    items = staged(named.select("item_words").distinct().select(F.monotonically_increasing_id().alias("item"), "item_words"), "items")
    names = staged(named.join(items, "item_words").select("item", "item_id"), "names")
    short = [r.n for r in items.where(F.size("item_words") <= LISTED).select(F.size("item_words").alias("n")).distinct().orderBy("n").limit(LISTED).collect()]
    shapes = _shapes(short, share)
    seeds = staged(items.select("item", "item_words").mapInArrow(_seed_batches(shapes), "item long, at int, seed long"), "seeds")

    # the bit map: two bits of each seed, gathered as bytes of a map of fixed size
    bits = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND((1 << MAP_BITS) - 1), F.shiftrightunsigned("seed", 64 - MAP_BITS))).alias("b"))
    words = bits.select(F.shiftright("b", 5).cast("int").alias("w"), F.expr("shiftleft(1L, CAST(b & 31 AS INT))").alias("m"))
    table = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    for part in words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow().to_batches():  # at most 2**(MAP_BITS - 5) rows
        table[part.column(0).to_numpy()] = part.column(1).to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(table.astype("<u4").tobytes())

    part = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    seen = part.mapInArrow(_scan_batches(shapes, shared), "doc_id long, key long, words array<long>, at array<int>, seed array<long>")
    seen = staged(seen.withColumn("row", F.monotonically_increasing_id()), "suspects")
    hits = seen.select("row", F.explode(F.arrays_zip("at", "seed")).alias("x")).select("row", F.col("x.at").alias("doc_at"), F.col("x.seed").alias("seed"))
    offsets = hits.join(seeds, "seed").select("row", "item", (F.col("doc_at") - F.col("at")).alias("offset")).distinct()
    pairs = offsets.groupBy("row", "item").agg(F.collect_list("offset").alias("offsets"))  # of one document and one item
    both = pairs.join(seen.select("row", "doc_id", "key", "words"), "row").join(items, "item")
    both = both.select("doc_id", "key", "item", "words", "item_words", "offsets")
    found = both.mapInArrow(_verify_batches(share), "doc_id long, key long, item long, n_matched long, n_item_words long")
    enough = (F.col("n_matched") >= F.lit(share) * F.col("n_item_words")) | (F.col("n_matched") >= least)
    found = found.where(enough).distinct().join(names, "item")
    return found.select("doc_id", "key", "item_id", "n_matched", "n_item_words")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_item_words: int = 1) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns as they are.

    Items of fewer than ``min_item_words`` words drop nothing: raise it where the
    benchmark has items of a word or a common phrase, which clean documents hold too.
    """
    bad_id, bad_key = fresh(docs, "_bad_id"), fresh(docs, "_bad_key")
    bad = leaks(docs, benchmark, id_col=id_col, text_col=text_col, min_item_words=min_item_words).select(F.col("doc_id").alias(bad_id), F.col("key").alias(bad_key)).distinct()
    bad = staged(bad, "leaks")
    same = docs[id_col].cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_of(text_col)) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
