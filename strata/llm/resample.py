"""Importance resampling towards a target distribution.

Features of a text are its runs of 1 to ``grams`` words (see ``bags``); a feature's
bucket is the crc32 of its bytes modulo ``buckets``. All documents and all target
texts are counted by bucket, which gives one array of gains; a document's weight is
the floored mean of its features' gains, its score the weight plus Gumbel noise from
a hash of its id, so the highest scores are a weighted sample without replacement.

The cutoff is selected, not sorted for: each task hands in the median of every chunk
of the keys that it still holds, the driver takes the median of those medians weighted
by chunk sizes, and at least a quarter of the keys lies on either side of it. One
count tells which side the wanted key is on; the other side is dropped, and the rest is
written down, so all rounds together cost a few passes over the first. Only the winners
are sorted, in ranges, and numbered from the sizes of the ranges before them.

Defined results: a null text has no words; a document with fewer than ``least`` words
is scored, never drawn; without any feature the weight is 0. A null id hashes as the
empty string and comes after all ids at the same score. Rows that repeat an id are
documents of their own; of rows equal in score and id, as many are drawn as fit, in
the order of their weight and features. An empty target or an empty table is no error.
Other columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bags import flat, lists, raw_texts, run_counts
from strata.llm.tables import small_batches, staged

#: Keys of which one median is taken, and keys that are sorted on the driver at last.
CHUNK, FEW = 1 << 20, 4096

_VECTOR = "buckets array<int>, counts array<bigint>, n_features bigint, n_words bigint"


def _vector_batches(grams: int, buckets: int):
    """For mapInArrow over rows that end with a text: the bucket counts instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            at, held, times, features, words = [0], [], [], [], []
            for raw in raw_texts(batch.column(batch.num_columns - 1)):
                counts, n, total = run_counts(raw, grams)
                own: dict[int, int] = {}
                for feature, c in counts.items():
                    b = known.get(feature)
                    if b is None:
                        if len(known) >= CHUNK:
                            known.clear()
                        b = known[feature] = zlib.crc32(feature) % buckets
                    own[b] = own.get(b, 0) + c
                held.extend(own)
                times.extend(own.values())
                at.append(len(held))
                features.append(n)
                words.append(total)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], lists(at, held, pa.int32()), lists(at, times, pa.int64()), pa.array(features, pa.int64()), pa.array(words, pa.int64())],
                names=[*batch.schema.names[:-1], "buckets", "counts", "n_features", "n_words"],
            )

    return run


def _total_batches(buckets: int):
    """For mapInArrow over (buckets, counts): each task's totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            _, held = flat(batch.column(0))
            np.add.at(totals, held, flat(batch.column(1))[1])
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(totals[found], pa.int64())], names=["bucket", "n"])

    return run


def bucket_totals(vectors: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences by bucket over all rows: one array of fixed size on the driver."""
    by_task = vectors.select("buckets", "counts").mapInArrow(_total_batches(buckets), "bucket int, n bigint")
    totals = np.zeros(buckets, np.int64)
    for row in by_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row.bucket] = row.n
    return totals


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio target : own) of each bucket."""
    n, s, t = len(own), int(own.sum()), int(target.sum())
    ratios = ((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)) for a, b in zip(own.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def _weight_batches(gain: np.ndarray):
    """For mapInArrow over (doc_id, buckets, counts, n_features, n_words): the weight instead of the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held = flat(batch.column(1))
            sums = np.zeros(len(held) + 1, np.int64)
            np.cumsum(gain[held] * flat(batch.column(2))[1], out=sums[1:])
            n = np.asarray(batch.column(3))
            weight = (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), pa.array(weight, pa.int64())], names=["doc_id", "n_features", "n_words", "weight"])

    return run


def _noise(seed: int):
    """floor of 1000 times a Gumbel value made from the first 32 bits of sha256(seed:doc_id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


# -- selection -------------------------------------------------------------------

#: The order of keys as one ascending value: high scores, then small ids, null ids last.
_KEY = ("down", "none", "id")


def _median_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over keys: the median of every chunk, and the chunk's size."""
    held, size = [], 0

    def middle() -> pa.RecordBatch:
        columns = [np.concatenate([part[i] for part in held]) for i in range(3)]
        at = np.lexsort(columns[::-1])[(size - 1) // 2]
        return pa.RecordBatch.from_arrays([pa.array([int(c[at])], pa.int64()) for c in columns] + [pa.array([size], pa.int64())], names=[*_KEY, "n"])

    for batch in batches:
        held.append([np.asarray(c) for c in batch.columns])
        size += batch.num_rows
        if size >= CHUNK:
            yield middle()
            held, size = [], 0
    if size:
        yield middle()


def kth_key(keys: DataFrame, k: int) -> tuple[int, int, int]:
    """The ``k``-th smallest (down, none, id) of a table of such keys (longs, k from 1), by weighted medians of medians."""
    left = staged(keys.select(*_KEY), "keys")
    n = left.count()
    whole = F.struct(*_KEY)
    while n > FEW:
        medians = sorted(tuple(r) for r in left.mapInArrow(_median_batches, "down bigint, none bigint, id bigint, n bigint").collect())
        seen, pivot = 0, None
        for *key, size in medians:
            seen += size
            if 2 * seen >= n:
                pivot = tuple(key)
                break
        at = F.struct(*(F.lit(x).cast("bigint").alias(c) for x, c in zip(pivot, _KEY, strict=True)))
        found = left.agg(F.count_if(whole < at).alias("before"), F.count_if(whole == at).alias("same")).first()
        if found.before < k <= found.before + found.same:
            return pivot
        if k <= found.before:
            left, n = left.where(whole < at), found.before
        else:
            left, n, k = left.where(whole > at), n - found.before - found.same, k - found.before - found.same
        left = staged(left, "keys")
    return tuple(left.orderBy(*_KEY).collect()[k - 1])


def numbered(winners: DataFrame, *order) -> DataFrame:
    """Rows sorted by ``order``, numbered 1, 2, 3 ... in ``rank``."""
    ordered = staged(winners.orderBy(*order).withColumn("rank", F.monotonically_increasing_id()), "winners")
    part, place = F.shiftright("rank", 33), F.col("rank").bitwiseAND((1 << 33) - 1)  # a task's number and the row's place in it
    sizes = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row for each task
    starts, before = [], 0
    for row in sizes:
        starts.append((row["part"], before))
        before += row["count"]
    spark = winners.sparkSession
    offsets = spark.createDataFrame(starts, "part bigint, before bigint")
    ordered = ordered.withColumn("part", part).withColumn("place", place)
    return ordered.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document.

    ``docs`` has doc_id and text, ``target`` has text. Of the documents with at least
    ``least`` words, the floor of ``percent`` in a hundred are drawn.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vectors = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_vector_batches(grams, buckets), f"doc_id bigint, {_VECTOR}")
    vectors = staged(vectors, "vectors")
    wanted = target.select("text").mapInArrow(_vector_batches(grams, buckets), _VECTOR)
    gain = gains(bucket_totals(vectors, buckets), bucket_totals(wanted, buckets))
    weights = vectors.select("doc_id", "buckets", "counts", "n_features", "n_words").mapInArrow(_weight_batches(gain), "doc_id bigint, n_features bigint, n_words bigint, weight bigint")
    scored = staged(weights.withColumn("score", F.col("weight") + _noise(seed)), "scored")

    able = F.col("n_words") >= least
    keyed = scored.withColumns({"down": -F.col("score"), "none": F.col("doc_id").isNull().cast("bigint"), "id": F.coalesce("doc_id", F.lit(0).cast("bigint"))})
    draw = keyed.where(able).count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    if not draw:
        return scored.withColumn("rank", F.lit(None).cast("bigint")).select(out)
    cut = kth_key(keyed.where(able), draw)
    at = F.struct(*(F.lit(x).cast("bigint").alias(c) for x, c in zip(cut, _KEY, strict=True)))
    won = able & (F.struct(*_KEY) <= at)
    ranked = numbered(keyed.where(won), *_KEY, "weight", "n_features")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))  # rows equal to the cutoff may be too many
    return ranked.select(out).union(keyed.where(~won).withColumn("rank", F.lit(None).cast("bigint")).select(out))
