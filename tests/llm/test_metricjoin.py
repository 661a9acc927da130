"""The metric range join against all pairs, and its bounds against distances."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import metricjoin

NAN, INF = float("nan"), float("inf")


def brute(rows, cosine=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if good else None for good, (_, v) in zip(ok, rows, strict=True)]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine] for i in range(n)]
    label = list(range(n))
    for start in range(n):
        todo = [start]
        while todo:
            for j in links[todo.pop()]:
                if label[j] > label[start]:
                    label[j] = label[start]
                    todo.append(j)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [v for k, (v, _) in enumerate(rows) if label[k] == label[i] and v is not None]
        component = min(ids) if ids else None
        out.append((vec_id, len(links[i]), component, vec_id == component))
    return sorted(out, key=repr)


def run(spark, rows, cosine=0.9, kind="float"):
    table = spark.createDataFrame([(i, v) for i, v in rows], f"vec_id long, embedding array<{kind}>").repartition(3)
    return sorted((tuple(r) for r in metricjoin.near_vectors(table, cosine).collect()), key=repr)


def mixed(seed, n=400, size=16):
    """Loose and tight groups, chains, scaled copies and lone vectors."""
    rnd = np.random.default_rng(seed)
    out = [rnd.normal(size=size) for _ in range(n // 4)]
    for spread in (0.02, 0.1, 0.25, 0.5):
        centre = rnd.normal(size=size)
        out += [centre + spread * rnd.normal(size=size) * np.linalg.norm(centre) / math.sqrt(size) for _ in range(n // 8)]
    a, b = rnd.normal(size=size), rnd.normal(size=size)
    out += [math.cos(t) * a + math.sin(t) * b for t in np.linspace(0, 3, n // 8)]
    out += [3 * v for v in out[:20]] + out[20:40]
    order = rnd.permutation(len(out))
    return [(int(i), [float(np.float32(x)) for x in out[k]]) for i, k in enumerate(order)]


@pytest.mark.parametrize("seed, cosine", [(1, 0.9), (2, 0.9), (3, 0.7)])
def test_equals_brute_force(spark, monkeypatch, seed, cosine):
    monkeypatch.setattr(metricjoin, "CELL", 20)  # many cells, chunks and strips
    monkeypatch.setattr(metricjoin, "CHUNK", 16)
    monkeypatch.setattr(metricjoin, "STRIP", 5)
    rows = mixed(seed)
    assert run(spark, rows, cosine) == brute(rows, cosine)


def test_production_sizes(spark):
    rows = mixed(9, 1200, 24)
    assert run(spark, rows, kind="double") == brute(rows)


def test_one_hot_ball_is_counted(spark, monkeypatch):
    monkeypatch.setattr(metricjoin, "CELL", 50)
    monkeypatch.setattr(metricjoin, "CHUNK", 32)
    rnd = np.random.default_rng(4)
    centre = rnd.normal(size=12)
    rows = [(i, [float(np.float32(x)) for x in (centre + 0.01 * rnd.normal(size=12) if i % 3 else rnd.normal(size=12))]) for i in range(500)]
    assert run(spark, rows) == brute(rows)


def test_null_broken_and_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
        (8, [0.0, 3.0]), (None, [0.0, 5.0]), (None, [-1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (11, [-0.0, 1.0]), (None, None),
    ]
    assert run(spark, rows, kind="double") == brute(rows)
    assert run(spark, rows) == brute(rows)
    huge = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [5e-324, 0.0])]
    assert run(spark, huge, kind="double") == brute(huge)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1, True)]
    rows = mixed(6, 80)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("n", "node", "cell", "links", "root", "kept", "first", "label"):
        table = table.withColumn(name, F.lit("x"))
    assert sorted((tuple(r) for r in metricjoin.near_vectors(table).collect()), key=repr) == brute(rows)


def test_bounds_lose_no_link():
    """Every linked pair in two cells meets in exactly one of them."""
    cosine = 0.8
    r = math.sqrt(2 - 2 * cosine)
    x = np.array([v for _, v in mixed(11, 600, 6)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    column = pa.array(x.tolist(), pa.list_(pa.float64()))
    pivots, lengths = metricjoin.choose(column, cosine, 12)
    cell, far = metricjoin.home(x, pivots, lengths, r)
    least = np.array([far[cell == c].min(initial=9) if (cell == c).any() else -1 for c in range(24)])
    most = np.array([far[cell == c].max(initial=0) if (cell == c).any() else -1 for c in range(24)])
    to = metricjoin.reach(x, cell, pivots, r, least, most)
    linked = np.argwhere(np.triu(x @ x.T >= cosine, 1))
    assert len(linked) > 1000
    for a, b in linked:
        assert int(to[a, cell[b]]) + int(to[b, cell[a]]) <= 1
        if cell[a] != cell[b]:
            assert to[a, cell[b]] or to[b, cell[a]]
    inside = [(a, b) for c in range(0, 24, 2) for a in np.flatnonzero(cell == c) for b in np.flatnonzero(cell == c)]
    assert inside and all(x[a] @ x[b] >= cosine for a, b in inside)
