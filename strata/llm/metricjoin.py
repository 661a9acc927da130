"""Near-duplicate embeddings: an exact range join in metric space.

Cosines of unit vectors and their Euclidean distances order pairs alike, so a cosine of
``cosine`` or more is a distance of r or less. Equal vectors are one class first. Every
class belongs to the cell of the pivot nearest to it; a cell has a *ball*, the vectors
within r / 2 of the pivot, and the *rest*. By the triangle inequality

- any two vectors of a ball are linked, so balls are counted, not compared: a group of
  close copies costs its size, not its square;
- a vector x of another cell can be linked with the ball of q only if
  d(x, q) <= r + the ball's radius;
- it can be linked with the rest of q only if d(x, q) is within r of that rest's smallest
  and largest distance, and x lies within r of the plane between q and its own pivot.

Such x are replicated to the cell, in one direction for each pair of cells. A cell's
vectors and its replicas are cut into chunks of some ``CHUNK``; each pair of chunks is one
group that is compared on its own and returns, for each vector in it, how many it is
linked with and one vector that it is connected to. No pairs are emitted.

The number of pivots follows the number of classes (one for ``CELL``, at most
``PIVOTS``); they are means of close vectors in a sample of ``SAMPLE`` classes, densest
first, taken by hash. They decide how much is compared, never what is linked. In many
dimensions, vectors without any clusters are within reach of most planes: then nearly
all chunks meet, and work grows with the square of such vectors, at the rate of
matrix products.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing; vectors of different length don't link. Rows that repeat
an id are vectors of their own. A component's id is the smallest id in it that isn't
null, if there is one; a row with a null id is kept only where it has none. An empty
table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from strata.llm.bags import flat
from strata.llm.components import roots
from strata.llm.tables import small_batches, staged

SAMPLE, PIVOTS, CELL = 2048, 512, 2048
#: Vectors on one side of a comparison, and those of them that are multiplied at once.
CHUNK, STRIP = 4096, 512
#: Distances are taken to be wrong by so much at most.
EPS = 1e-7


def units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length in a list column: the rows of that length, and their unit vectors in double precision."""
    at, values = flat(column)
    sizes = np.diff(at)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = values[at[rows][:, None] + np.arange(size)].astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _wide(x: np.ndarray, size: int) -> np.ndarray:
    """Vectors with zeros added, or left as they are."""
    return x if x.shape[1] >= size else np.pad(x, ((0, 0), (0, size - x.shape[1])))


def choose(sample: pa.Array, cosine: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots (unit vectors, zeros added) and their lengths from a sample of vectors."""
    found, lengths = [], []
    for _, x in units(sample):
        close = x @ x.T >= cosine
        taken = np.zeros(len(x), bool)
        for i in np.argsort(-close.sum(axis=1), kind="stable"):
            if not taken[i]:
                taken |= close[i]
                mean = x[close[i]].mean(axis=0)
                found.append((int(close[i].sum()), mean / np.linalg.norm(mean)))
                lengths.append(x.shape[1])
    order = sorted(range(len(found)), key=lambda i: -found[i][0])[:most]
    size = max(lengths, default=0)
    return np.array([np.pad(found[i][1], (0, size - lengths[i])) for i in order]).reshape(len(order), size), np.array([lengths[i] for i in order], np.int64)


def _cosines(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    size = max(x.shape[1], pivots.shape[1])
    return np.clip(_wide(x, size) @ _wide(pivots, size).T, -1.0, 1.0)


def home(x: np.ndarray, pivots: np.ndarray, lengths: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cell (2p the ball of pivot p, 2p + 1 the rest) and its distance from the pivot."""
    cosines = _cosines(x, pivots)
    own = cosines.argmax(axis=1)
    away = np.sqrt(2.0 - 2.0 * cosines[np.arange(len(x)), own])
    in_ball = (away <= r / 2 - EPS) & (lengths[own] == x.shape[1])
    return 2 * own + ~in_ball, away


def _cell_batches(pivots: np.ndarray, lengths: np.ndarray, r: float):
    """For mapInArrow over (node, n, embedding): the cell, and the distance from its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for rows, x in units(batch.column(2)):
                cells[rows], far[rows] = home(x, pivots, lengths, r)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32()), pa.array(far, pa.float64())], names=["node", "n", "embedding", "cell", "far"])

    return run


def reach(x: np.ndarray, cell: np.ndarray, pivots: np.ndarray, r: float, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which vectors, with their own ``cell``, go to which other cells (vectors x cells).

    ``least``, ``most``: the smallest and largest distance of each cell's vectors from
    its pivot; -1 where a cell is empty.
    """
    cosines, own = _cosines(x, pivots), cell // 2
    away = np.sqrt(2.0 - 2.0 * cosines)
    rows = np.arange(len(x))
    gaps = np.sqrt(np.clip(2.0 - 2.0 * pivots @ pivots.T, 0.0, None))
    out = np.zeros((len(x), 2 * len(pivots)), bool)
    in_ball = cell % 2 == 0
    number = np.arange(len(pivots))
    one_way = ((number[None, :] + own[:, None]) % 2 == 0) == (number[None, :] > own[:, None])  # of a pair of pivots, one sends
    one_way &= number[None, :] != own[:, None]
    near = (most[::2] >= 0) & (away <= most[::2] + r + EPS)
    out[:, ::2] = near & (one_way | ~in_ball[:, None])  # the rest goes to balls, never a ball to a rest
    ring = (most[1::2] >= 0) & (away <= most[1::2] + r + EPS) & (away >= least[1::2] - r - EPS)
    plane = cosines[rows, own][:, None] - cosines <= r * gaps[own] + EPS
    out[:, 1::2] = ring & plane & one_way & ~in_ball[:, None]
    return out


def _reach_batches(pivots: np.ndarray, r: float, least: np.ndarray, most: np.ndarray):
    """For mapInArrow over (node, n, embedding, cell): the other cells that each vector goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list[list[int]] = [[] for _ in range(batch.num_rows)]
            own = np.asarray(batch.column(3)).astype(np.int64)
            for rows, x in units(batch.column(2)):
                for row, to in zip(rows, reach(x, own[rows], pivots, r, least, most), strict=True):
                    cells[row] = np.flatnonzero(to).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cells, pa.list_(pa.int32()))], names=["node", "n", "embedding", "cells"])

    return run


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels with the labels of linked places (a, b) made one, the smaller."""
    one, two = label[a], label[b]
    apart = one != two
    if not apart.any():
        return label
    up = np.arange(len(label))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for p in np.unique(one[apart] * len(label) + two[apart]):
        i, j = top(int(p) // len(label)), top(int(p) % len(label))
        up[max(i, j)] = min(i, j)
    while True:
        step = up[up]
        if (step == up).all():
            return up[label]
        up = step


def _linked(cosine: float):
    """For applyInArrow over a pair of chunks (side, node, n, embedding): links of each vector, and one it is connected to."""

    def run(group: pa.Table) -> pa.Table:
        side = np.asarray(group.column("side"))
        node = np.asarray(group.column("node"))
        n = np.asarray(group.column("n"))
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))
        alone = not side.any()
        for rows, x in units(group.column("embedding").combine_chunks()):
            left = np.flatnonzero(side[rows] == 0)
            right = left if alone else np.flatnonzero(side[rows] == 1)
            for lo in range(0, len(left), STRIP):
                part = left[lo : lo + STRIP]
                found = x[part] @ x[right].T >= cosine
                if alone:
                    found &= right[None, :] > part[:, None]
                a, b = np.nonzero(found)
                if len(a):
                    a, b = rows[part[a]], rows[right[b]]
                    links += np.bincount(a, n[b], len(node)).astype(np.int64) + np.bincount(b, n[a], len(node)).astype(np.int64)
                    label = _join(label, a, b)
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[some], pa.int64()), "links": pa.array(links[some], pa.int64()), "to": pa.array(node[label[some]], pa.int64())})

    return run


def near_vectors(table: DataFrame, cosine: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of a table (vec_id, embedding); 0 < ``cosine`` < 1."""
    spark = table.sparkSession
    small_batches(spark, 4096)
    r = math.sqrt(2.0 - 2.0 * cosine)
    given = table.schema["embedding"].dataType
    kind = "array<float>" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "array<double>"
    table = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))

    nodes = table.where(valid).groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    total = nodes.count()
    sample = nodes.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).toArrow().column(0).combine_chunks()
    pivots, lengths = choose(sample, cosine, max(1, min(PIVOTS, -(-total // CELL))))
    alone = table.where(~valid).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not len(pivots):
        return alone

    homes = nodes.select("node", "n", "embedding").mapInArrow(_cell_batches(pivots, lengths, r), f"node bigint, n bigint, embedding {kind}, cell int, far double")
    homes = staged(homes, "homes")
    least, most, home_rows, probe_rows = (np.full(2 * len(pivots), x) for x in (-1.0, -1.0, 0, 0))
    for row in homes.groupBy("cell").agg(F.min("far").alias("least"), F.max("far").alias("most"), F.count("*").alias("rows")).collect():  # two for each pivot at most
        least[row["cell"]], most[row["cell"]], home_rows[row["cell"]] = row["least"], row["most"], row["rows"]
    sent = homes.select("node", "n", "embedding", "cell").mapInArrow(_reach_batches(pivots, r, least, most), f"node bigint, n bigint, embedding {kind}, cells array<int>")
    sent = staged(sent.where(F.size("cells") > 0), "sent")
    for row in sent.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():
        probe_rows[row["cell"]] = row["count"]

    # Chunks 0 .. h - 1 of a cell are its own vectors, h .. h + p - 1 its replicas.
    sizes = [(c, -(-int(home_rows[c]) // CHUNK), -(-int(probe_rows[c]) // CHUNK)) for c in range(2 * len(pivots)) if home_rows[c]]
    sizes = F.broadcast(spark.createDataFrame(sizes, "cell int, h int, p int"))
    c, h = F.col("c"), F.col("h")
    rest = F.col("cell") % 2 == 1
    own = homes.join(sizes, "cell").where(rest | (F.col("p") > 0)).withColumn("c", F.pmod(F.xxhash64("node"), h).cast("int"))
    own_pairs = F.transform(
        F.filter(F.sequence(F.lit(0), h + F.col("p") - 1), lambda q: rest | (q >= h)),
        lambda q: F.struct(F.least(q, c).alias("i"), F.greatest(q, c).alias("j"), (q < c).cast("int").alias("side")),
    )
    own = own.select("cell", F.explode(own_pairs).alias("at"), "node", "n", "embedding")
    probes = sent.select(F.explode("cells").alias("cell"), "node", "n", "embedding").join(sizes, "cell").withColumn("c", h + F.pmod(F.xxhash64("node"), F.col("p")).cast("int"))
    probe_pairs = F.transform(F.sequence(F.lit(0), h - 1), lambda q: F.struct(q.alias("i"), c.alias("j"), F.lit(1).alias("side")))
    probes = probes.select("cell", F.explode(probe_pairs).alias("at"), "node", "n", "embedding")
    pairs = own.union(probes).select("cell", "at.i", "at.j", "at.side", "node", "n", "embedding")
    compared = pairs.groupBy("cell", "i", "j").applyInArrow(_linked(cosine), "node bigint, links bigint, to bigint")
    compared = staged(compared, "compared")

    balls = homes.where("cell % 2 = 0").groupBy("cell").agg(F.sum("n").alias("rows"), F.min("node").alias("to"))  # one for each pivot at most
    in_balls = homes.where("cell % 2 = 0").join(F.broadcast(balls), "cell").select("node", (F.col("rows") - F.col("n")).alias("links"), "to")
    every = compared.union(in_balls)
    counted = every.groupBy("node").agg(F.sum("links").alias("links"))
    component = roots(every.select(F.col("node").alias("a"), F.col("to").alias("b"))).select("node", "root")
    found = nodes.join(counted, "node", "left").join(component, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = staged(found.select("root", "first", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "found")
    ids = found.groupBy("root").agg(F.min("first").alias("component_id"))
    by_vector = found.join(ids, "root").select("embedding", "n_links", "component_id")
    linked = table.where(valid).join(by_vector, "embedding").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.union(alone)
