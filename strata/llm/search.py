"""Ranked lexical search of all documents for each item of a query set.

Bag deduplication: a document's counts are restricted to the vocabulary of the items;
documents with the same restricted counts and the same length factor m get the same
score for every item, so they are one class. Classes are found by a hash and the counts
themselves, scored once, and only those that reach a ranking are expanded to their
members by ascending id.

Scoring is a product of two matrices, classes x terms and terms x items, in blocks: a
task holds some thousand classes and the items of one tile, and keeps the best classes
of each item as it goes. All values are integers below 2**53, so doubles add them
exactly (beyond that, which takes items of some 100,000 terms, the product is taken
in 64-bit integers).

Items are taken in groups of at most ``ITEMS`` items and ``PAIRS`` terms (one item at
least), with a pass over the documents for each group: what is sent to all executors is
a group's terms and, for the best classes, ``top`` keys an item.

Defined results: a null text has no terms, so it counts for nothing and isn't found; an
item without terms, or with none that a document holds, has no rows. Rows that repeat an id
are documents, or items, of their own. A null doc_id comes after all others at the
same score. Empty tables give an empty result. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bags import flat, lists, raw_texts, word_counts
from strata.llm.tables import small_batches, staged

#: Most items and (item, term) pairs of a group.
ITEMS, PAIRS = 4096, 1 << 20
#: Classes that are scored at once, and items of a tile.
CLASSES, TILE = 2048, 256


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (item_id, text): the distinct terms instead of the text."""
    for batch in batches:
        terms = [sorted(word_counts(raw)[0]) for raw in raw_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _bag_batches(vocabulary: dict[bytes, int]):
    """For mapInArrow over (doc_id, text): the number of terms, and counts of those in the vocabulary by term number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, at, ids, counts = [], [0], [], []
            for raw in raw_texts(batch.column(1)):
                found, n = word_counts(raw)
                held = sorted((vocabulary[t], c) for t, c in found.items() if t in vocabulary)
                ids.extend(t for t, _ in held)
                counts.extend(c for _, c in held)
                at.append(len(ids))
                sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), lists(at, ids, pa.int32()), lists(at, counts, pa.int32())],
                names=["doc_id", "n", "ids", "tfs"],
            )

    return run


def _frequency_batches(size: int):
    """For mapInArrow over (ids): in how many of a task's documents each term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(flat(batch.column(0))[1], minlength=size)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], names=["id", "df"])

    return run


class _Best:
    """The best ``top`` classes of each item: highest score, then smallest first id (null last)."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.zeros(items, np.int64)  # the score to reach
        self.held = [(np.zeros(0, np.int64),) * 3 for _ in range(items)]  # score, first, class

    def add(self, lo: int, scores: np.ndarray, first: np.ndarray, cls: np.ndarray) -> None:
        """``scores``: classes x items from ``lo`` on."""
        reach = scores >= np.maximum(self.least[lo : lo + scores.shape[1]], 1)
        for item in np.flatnonzero(reach.any(axis=0)):
            rows = np.flatnonzero(reach[:, item])
            new = (scores[rows, item], first[rows], cls[rows])
            score, one, which = (np.concatenate(x) for x in zip(self.held[lo + item], new, strict=True))
            order = np.lexsort((which, one, -score))[: self.top]
            self.held[lo + item] = (score[order], one[order], which[order])
            if len(order) == self.top:
                self.least[lo + item] = score[order[-1]]


def _score_batches(items: list[np.ndarray], weights: np.ndarray, saturation: int, top: int):
    """For mapInArrow over (cls, first, m, ids, tfs): each task's best classes of each item.

    ``items``: the term numbers of each item; ``weights``: the weight of each term.
    """
    exact = max((len(x) for x in items), default=0) * int(weights.max(initial=0)) * 10**6 < 1 << 53
    kind = np.float64 if exact else np.int64

    def tiles() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First item, the tile's terms, and which term is in which item."""
        for lo in range(0, len(items), TILE):
            part = items[lo : lo + TILE]
            terms = np.unique(np.concatenate(part)) if part else np.zeros(0, np.int64)
            held = np.zeros((len(terms), len(part)), kind)
            for i, own in enumerate(part):
                held[np.searchsorted(terms, own), i] = 1
            yield lo, terms, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items), top)
        one_tile = list(tiles()) if len(items) <= TILE else None

        def score(rows: list[tuple]) -> None:
            cls, first, m, sizes, ids, tfs = (np.concatenate(x) for x in zip(*rows, strict=True))
            of = np.repeat(np.arange(len(cls)), sizes)
            tf = tfs.astype(np.int64)
            value = weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + saturation * m[of]))
            for lo, terms, held in one_tile or tiles():
                at = np.minimum(np.searchsorted(terms, ids), max(len(terms) - 1, 0))
                here = terms[at] == ids if len(terms) else np.zeros(len(ids), bool)
                matrix = np.zeros((len(cls), len(terms)), kind)
                matrix[of[here], at[here]] = value[here]
                best.add(lo, (matrix @ held).astype(np.int64), first, cls)

        rows, n = [], 0
        for batch in batches:
            at, ids = flat(batch.column(3))
            first = np.asarray(batch.column(1).fill_null(np.iinfo(np.int64).max))
            rows.append((np.asarray(batch.column(0)), first, np.asarray(batch.column(2)), np.diff(at), ids, flat(batch.column(4))[1]))
            n += batch.num_rows
            if n >= CLASSES:
                score(rows)
                rows, n = [], 0
        if rows:
            score(rows)
        for item, (scores, _, cls) in enumerate(best.held):
            if len(cls):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cls), item), pa.int32()), pa.array(scores, pa.int64()), pa.array(cls, pa.int64())], names=["item", "score", "cls"])

    return run


def _search(docs: DataFrame, rows: list, top: int, share: int, saturation: int) -> DataFrame:
    """item (its place in ``rows``), rank, doc_id and score for one group of items."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
    items = [np.array([vocabulary[bytes(t)] for t in r.terms], np.int64) for r in rows]
    bags = staged(docs.mapInArrow(_bag_batches(vocabulary), "doc_id bigint, n bigint, ids array<int>, tfs array<int>"), "bags")

    total = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    held = bags.select("ids").mapInArrow(_frequency_batches(len(vocabulary)), "id int, df bigint").groupBy("id").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for row in held.collect():  # one for each term of the group at most
        weights[row.id] = math.floor(1000 * math.log((2 * total.docs + 2) / (2 * row.df + 1)))

    m = F.lit(100 - share) + F.expr(f"({share} * n * {total.docs}L) div {max(total.terms or 0, 1)}L")
    bags = bags.where(F.size("ids") > 0).withColumn("m", m).withColumn("key", F.xxhash64("ids", "tfs", "m"))
    same = ["key", "m", "ids", "tfs"]
    classes = bags.groupBy(*same).agg(F.min("doc_id").alias("first"))
    classes = staged(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    found = classes.select("cls", "first", "m", "ids", "tfs").mapInArrow(_score_batches(items, weights, saturation, top), "item int, score bigint, cls bigint")
    found = found.join(classes.select("cls", "first", "key"), "cls")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "cls")
    found = staged(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top), "best")

    # top keys an item at most, so ITEMS * top of 8 bytes
    near = bags.join(F.broadcast(found.select("key").distinct()), "key", "left_semi")
    by_id = Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id"))
    members = near.withColumn("no", F.row_number().over(by_id)).where(F.col("no") <= top)
    named = classes.join(found.select("cls").distinct(), "cls", "left_semi").select("cls", *same)
    members = members.join(named, same).select("cls", "doc_id", "no")
    whole = found.join(members, "cls").where(F.col("place") + F.col("no") <= top + 1)  # each class before has a better document
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = 50, share: int = 50, saturation: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` documents (doc_id, text) with a score above 0.

    ``share``: the part, in a hundred, that a document's length has in m;
    ``saturation``: how soon repeats of a term stop to count.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType
    sets = items.select("item_id", "text").mapInArrow(_item_batches, f"item_id {kind.simpleString()}, terms array<binary>")
    sets = staged(sets.where(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id()), "items")
    size = sets.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("pairs")).first()
    groups = max(1, -(-2 * size.items // ITEMS) if size.items > ITEMS else 1, -(-2 * size.pairs // PAIRS) if size.pairs > PAIRS else 1)
    while groups > 1:  # hashing may fill a group above the bounds
        full = sets.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g")).agg(F.count("*").alias("items"), F.sum(F.size("terms")).alias("pairs"))
        if full.where((F.col("items") > 1) & ((F.col("items") > ITEMS) | (F.col("pairs") > PAIRS))).isEmpty():
            break
        groups *= 2
    parts = []
    for g in range(groups):
        own = sets.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == g)
        rows = own.select("row", "terms").orderBy("row").collect()
        if rows:
            names = spark.createDataFrame([(i, r["row"]) for i, r in enumerate(rows)], "item int, row bigint")
            parts.append(_search(docs, rows, top, share, saturation).join(F.broadcast(names), "item").join(own.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.union, parts)
