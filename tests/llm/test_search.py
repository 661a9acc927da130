"""Lexical search against a plain Python version."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(t.translate(LOWER) for t in TERM.findall(text or ""))


def brute(docs, items, top=50, share=50, saturation=20):
    held = [(doc_id, terms(text)) for doc_id, text in docs]
    held = [(doc_id, t) for doc_id, t in held if t]
    n, total = len(held), sum(sum(t.values()) for _, t in held)
    df = Counter(x for _, t in held for x in t)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, t in held:
            m = 100 - share + (share * sum(t.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * t[x]) // (1000 * t[x] + saturation * m)) for x in terms(text) if x in t)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    words = [f"Term{i}" for i in range(60)] + ["Straße", "ΔΕΛΤΑ", "a1"]
    docs = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choices(words, k=rnd.choice([0, 1, 3, 10, 40])))) for i in range(n)]
    items = [(i, " ".join(rnd.choices([*words, "unseen"], k=rnd.choice([1, 4, 9])))) for i in range(25)]
    return docs, items


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in search.search(d, i, **kw).collect()), key=repr)


@pytest.mark.parametrize("top", [1, 5, 50])
def test_equals_brute_force(spark, monkeypatch, top):
    monkeypatch.setattr(search, "CLASSES", 7)  # many steps, several tiles
    monkeypatch.setattr(search, "TILE", 4)
    docs, items = corpus(250)
    assert run(spark, docs, items, top=top) == brute(docs, items, top=top)


def test_a_hot_class_is_expanded_by_ascending_id(spark):
    rnd = random.Random(5)
    ids = list(range(1000, 1400))
    rnd.shuffle(ids)
    docs = [(i, "alpha Beta gamma other" if i % 2 else "gamma ALPHA beta filler") for i in ids]  # the same bag and length: one class
    docs += [(i, "alpha beta gamma alpha") for i in range(5)] + [(2000 + i, f"alpha x{i}") for i in range(30)]
    items = [(1, "alpha beta"), (2, "gamma"), (3, "x7 alpha")]
    assert run(spark, docs, items) == brute(docs, items)


def test_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEMS", 4)
    monkeypatch.setattr(search, "PAIRS", 20)
    docs, items = corpus(60)
    assert run(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_null_empty_repeated_rows_and_names(spark):
    docs = [(1, None), (2, ""), (3, "--- !!"), (None, "apple pear"), (4, "apple pear"), (4, "apple pear"), (5, "apple"), (6, "x " * 50_000 + "pear")]
    items = [(1, None), (2, ""), (3, "apple"), (3, "apple"), (None, "pear x"), (4, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    for name in ("n", "m", "ids", "tfs", "key", "cls", "rank", "score", "item"):
        d, i = d.withColumn(name, F.lit("x")), i.withColumn(name, F.lit("x"))
    assert sorted((tuple(r) for r in search.search(d, i).collect()), key=repr) == brute(docs, items)


def test_string_item_ids(spark):
    d = spark.createDataFrame([(1, "apple"), (2, "pear")], "doc_id long, text string")
    i = spark.createDataFrame([("q", "apple"), (None, "pear")], "item_id string, text string")
    assert {(r.item_id, r["rank"], r.doc_id) for r in search.search(d, i).collect()} == {("q", 1, 1), (None, 1, 2)}
