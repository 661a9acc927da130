"""Near-duplicate documents: bottom-k sketches of one hash function.

A document's sketch holds the ``k`` smallest hashes of its shingle set. Documents
with the same set are one class, and all further work is on classes.

Candidates. If two sets have a Jaccard similarity of t or more, then of the k
smallest hashes of their union about ``t * k`` are in both sketches. For k = 64
fewer than ``(t - SLACK) * k`` are so with a probability below 1e-6; a set so
small that all similar ones are their own sketches has an exact bound. Two
sketches with c values in common share one within the ``size - c + 1`` values
that are rarest in the corpus, so only those go into inverted lists, and values
that many documents hold drop out of long lists. Long lists are left over
where many documents have much in common, linked or not. The classes in them get
longer sketches, for which the bound is tighter (``LONG_SLACK``), and the lists of
those replace the long ones.

Links. Pairs from short lists (of ``SHORT`` classes at most) are estimated by the
sketch of the union, then decided on full sets. Lists that are still long aren't
paired out: classes that share any of them are a crowd. A crowd's classes are
first compared with one hub, the class with the fewest values of its own. Those
that are linked with it are one component, so only the rest is compared with the
crowd, in blocks: a task holds two blocks of ``BLOCK`` classes or so and returns
links that span what it found, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.components import roots
from strata.llm.tables import fresh, light, small_batches, staged, text_of

#: By how much the share in common of two sketches may fall short of t.
SLACK, LONG_SLACK = 0.3, 0.1
#: Longer lists aren't paired out; classes in them get sketches of LONG_SKETCH values.
SHORT, LONG_SKETCH = 16, 512
#: Classes of a crowd that are compared at once.
BLOCK = 512


def _digest(values: np.ndarray) -> bytes:
    """128 bits of a set of hashes, whatever its order."""
    n = np.uint64(len(values))
    one = textops.mix(values + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + n
    two = textops.mix(values ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) ^ n
    return one.tobytes() + two.tobytes()


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    for rows in textops.slices(column):
        words, at = textops.word_hashes(column[rows])
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            yield textops.shingle_set(words[lo:hi], n)


def _sketch_batches(n: int, k: int):
    """For mapInArrow over (doc_id, key, text): the size, digest and sketch of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for values in _sets(batch.column(2), n):
                sizes.append(len(values))
                digests.append(_digest(values) if len(values) else None)
                sketches.append(values[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n_shingles", "digest", "sketch"],
            )

    return run


def _set_batches(n: int):
    """For mapInArrow over (node, digest, text): the sorted set, where the text has the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, digest, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _sets(batch.column(2), n), strict=True):
                if _digest(values) == digest:
                    nodes.append(node)
                    sets.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "members"])

    return run


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, members) with sorted sets: (node, n, sketch) with long sketches."""
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        sketches = pa.array([x[:LONG_SKETCH] for x in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), sketches], names=["node", "n", "sketch"])


def _lists(sketches: DataFrame, k: int, percent: int, slack: float) -> DataFrame:
    """Inverted lists of each sketch's rarest values, from (node, n, sketch): (node, v, n, own).

    own: how many of a complete set's values no other sketch has; n and own are
    null for a set that is longer than its sketch.
    """
    values = sketches.select("node", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    by_node = values.join(shared, "v").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("held"))
    size = F.size("sketch")
    least_common = F.when(F.col("n") * 100 <= k * percent, F.ceil(F.col("n") * percent / 100)).otherwise(F.ceil(F.lit(percent / 100 - slack) * size))
    prefix = size - least_common + 1 - (size - F.size("held"))  # values that no other sketch has are the rarest
    lists = sketches.join(by_node, "node").withColumn("take", F.greatest(prefix, F.lit(0)).cast("int")).where("take > 0")
    whole = F.col("n") <= k
    lists = lists.withColumn("own", F.when(whole, size - F.size("held"))).withColumn("n", F.when(whole, F.col("n")))
    return lists.select("node", "n", "own", F.explode(F.slice("held", F.lit(1), F.col("take"))).alias("x")).select("node", "x.v", "n", "own")


def _confirm_batches(percent: int):
    """For mapInArrow over (a, b, members_a, members_b): the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3), strict=True):
                one, two = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _spanning(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks of sets (the same or disjoint): to each set its component's first."""
    size = np.array([len(x) for x in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(len(sets)), size), times[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        some = slice(*np.searchsorted(column, [lo, lo + 4096]))
        one, two = np.zeros((len(left), 4096), np.float32), np.zeros((len(right), 4096), np.float32)
        for table, place in ((one, place_l[row[some]]), (two, place_r[row[some]])):
            table[place[place >= 0], column[some][place >= 0] - lo] = 1
        common += one @ two.T
    linked = 100 * common >= percent * (size[left][:, None] + size[right][None] - common)
    i, j = np.nonzero(linked)
    i, j = left[i], right[j]
    first = np.arange(len(sets))
    while True:
        low = first.copy()
        np.minimum.at(low, i, first[j])
        np.minimum.at(low, j, first[i])
        low = low[low]
        if (low == first).all():
            break
        first = low
    some = np.flatnonzero(first != np.arange(len(sets)))
    return some, first[some]


def _block_batches(percent: int):
    """For mapInArrow over (crowd, kind, i, j, side, node, members), sorted: links between blocks i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def links() -> pa.RecordBatch:
            side = np.array([x[0] for x in held])
            every = np.arange(len(held))
            left, right = (every, every) if (side == side[0]).all() else (every[side == 0], every[side == 1])
            one, two = _spanning([x[2] for x in held], left, right, percent)
            nodes = np.array([x[1] for x in held])
            return pa.RecordBatch.from_arrays([pa.array(nodes[one]), pa.array(nodes[two])], names=["a", "b"])

        for batch in batches:
            for *key, side, node, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    if held:
                        yield links()
                    at, held = key, []
                held.append((side, node, np.frombuffer(members, np.uint64)))
        if held:
            yield links()

    return run


def _pairs(lists: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of the classes in one list."""
    one, two = lists.select("v", F.col("node").alias("a")), lists.select("v", F.col("node").alias("b"))
    return one.join(two, "v").where("a < b").select("a", "b").distinct()


def _crowd_links(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among classes that share long lists: (node, v, own) and their sets."""
    least = lists.groupBy("v").agg(F.min("node").alias("b"))
    crowds = roots(lists.join(least, "v").select(F.col("node").alias("a"), "b"))
    own = lists.groupBy("node").agg(F.min("own").alias("own"))
    ranked = crowds.withColumnRenamed("root", "crowd").join(own, "node")
    ranked = staged(ranked, "ranked")
    hubs = ranked.groupBy("crowd").agg(F.min(F.struct(F.coalesce("own", F.lit(1 << 30)), "node")).alias("x")).select("crowd", F.col("x.node").alias("hub"))
    people = staged(ranked.join(light(staged(hubs, "hubs")), "crowd").select("crowd", "node", "hub"), "crowds")
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    to_hub = people.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).join(one, "a").join(two, "b")
    to_hub = staged(to_hub.select("a", "b", "ma", "mb").mapInArrow(_confirm_batches(percent), "a long, b long"), "hub-links")

    # the rest (side 0) against itself and against those linked with the hub (side 1), in blocks
    linked = to_hub.select(F.col("a").alias("node"), F.lit(1).alias("s"))
    people = people.join(linked, "node", "left").withColumn("side", F.when(F.col("node") == F.col("hub"), 1).otherwise(F.coalesce("s", F.lit(0))))
    counts = people.groupBy("crowd").agg(F.sum(1 - F.col("side")).alias("rest"), F.sum("side").alias("near"))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    counts = counts.where("rest > 0").select("crowd", blocks("rest").alias("rest"), blocks("near").alias("near"))
    mine = people.join(light(staged(counts, "blocks")), "crowd").withColumn("i", F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("rest")).otherwise(F.col("near"))).cast("int"))
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    within = F.transform(numbers("rest"), lambda j: F.struct(F.lit(0).alias("kind"), F.least("i", j).alias("i"), F.greatest("i", j).alias("j")))
    across = F.transform(numbers("near"), lambda j: F.struct(F.lit(1).alias("kind"), F.col("i").alias("i"), j.alias("j")))
    back = F.transform(numbers("rest"), lambda j: F.struct(F.lit(1).alias("kind"), j.alias("i"), F.col("i").alias("j")))
    to = F.when(F.col("side") == 0, F.concat(within, across)).otherwise(back)
    dealt = mine.select("crowd", "node", "side", F.explode(to).alias("x")).join(sets, "node")
    dealt = dealt.select("crowd", "x.kind", "x.i", "x.j", "side", "node", "members")
    order = ["crowd", "kind", "i", "j"]
    found = dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(_block_batches(percent), "a long, b long")
    return to_hub.union(found)


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    left = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    near = pairs.join(left, "a").join(right, "b").withColumn("u", union)
    common = F.size(F.array_intersect(F.array_intersect("u", "sa"), F.col("sb")))
    near = near.where(common >= F.lit(percent / 100 - SLACK) * F.size("u")).select("a", "b")
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    both = near.join(one, "a").join(two, "b").select("a", "b", "ma", "mb")
    return both.mapInArrow(_confirm_batches(percent), "a long, b long")


def cluster(docs: DataFrame, shingle: int, percent: int, k: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    Returns one row per input row: ``doc_id``, ``key`` (a hash of the text),
    ``n_shingles``, ``component_id`` (the smallest id reachable over links) and
    ``kept`` (whether that is the row's own). A text without words, or null, has
    an empty set and is linked with nothing. Repeated rows are one class: all of
    them carry the same ``component_id``, and ``kept`` where the id is theirs. A
    null id never is a component's id unless all ids in it are null; such a
    component's rows have a null ``component_id`` and are kept. Further columns
    aren't read; an empty table gives no rows.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the candidate bound holds for similarities from 0.8 to 1")
    small_batches(docs.sparkSession)
    part = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    rows = part.mapInArrow(_sketch_batches(shingle, k), "doc_id long, key long, n_shingles long, digest binary, sketch array<long>")
    rows = staged(rows, "sketches")
    per_class = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "key")).alias("any"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = staged(per_class.select(F.monotonically_increasing_id().alias("node"), "digest", "any.doc_id", "any.key", "least", "n", "sketch"), "classes")

    def counted(lists: DataFrame) -> DataFrame:
        lists = staged(lists, "lists")
        return lists.join(staged(lists.groupBy("v").agg(F.count("*").alias("c")).where("c > 1"), "lengths"), "v")

    lists = counted(_lists(classes, k, percent, SLACK))

    # full sets of the classes in lists
    needed = lists.select("node").distinct()
    ask = classes.join(needed, "node", "left_semi").select("node", "digest", F.col("doc_id").alias("d"), F.col("key").alias("y"))
    texts = part.join(ask, part.doc_id.eqNullSafe(F.col("d")) & (part.key == F.col("y"))).select("node", "digest", "text")
    sets = texts.mapInArrow(_set_batches(shingle), "node long, members binary").dropDuplicates(["node"])
    sets = staged(sets, "sets")

    crowded = sets.join(lists.where(F.col("c") > SHORT).select("node").distinct(), "node", "left_semi")
    longer = staged(crowded.mapInArrow(_longer, "node long, n long, sketch array<long>"), "long-sketches")
    again = counted(_lists(longer, LONG_SKETCH, percent, LONG_SLACK))
    pairs = staged(_pairs(lists.where(F.col("c") <= SHORT)).union(_pairs(again.where(F.col("c") <= SHORT))).distinct(), "pairs")
    links = _confirmed(pairs, classes, sets, k, percent)
    many = staged(again.where(F.col("c") > SHORT).select("node", "v", "own"), "long-lists")
    if not many.isEmpty():
        links = links.union(_crowd_links(many, sets, percent))
    labels = roots(links)

    named = classes.select("node", "digest", "least")
    named = named.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("digest", "component_id")
    out = rows.select("doc_id", "key", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, shingle: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of every group: the one with the smallest id.

    Of repeated rows with that id one stays (the one whose text hash is smallest,
    then any). Rows without words and rows with a null id outside a group with
    ids all stay. All columns are returned as they are.
    """
    found = cluster(docs, shingle, percent, id_col=id_col, text_col=text_col)
    kept = found.where("kept")
    many = kept.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = many.groupBy("doc_id").agg(F.min("key").alias("key"), F.count("*").alias("c"))
    rest = kept.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "key", F.lit(1).alias("c")).distinct()
    own_id, own_key, copies = (fresh(docs, n) for n in ("_keep_id", "_keep_key", "_keep_copies"))
    keep = staged(first.union(rest).select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key), F.col("c").alias(copies)), "keep")
    same = docs[id_col].cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text_of(text_col)) == F.col(own_key))
    out = docs.join(keep.select(own_id, own_key), same, "left_semi")
    twice = keep.where(F.col(copies) > 1)
    if twice.isEmpty():
        return out
    same = out[id_col].cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text_of(text_col)) == F.col(own_key))
    return out.join(twice, same, "left_anti").unionByName(out.join(twice, same, "left_semi").dropDuplicates([id_col, text_col]))
