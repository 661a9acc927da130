"""Importance resampling against a plain Python version, and the selection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import bags, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, grams):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, grams=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, wanted = Counter(), Counter()
    for _, text in docs:
        own.update(map(bucket, features(text, grams)[1]))
    for text in target:
        wanted.update(map(bucket, features(text, grams)[1]))
    s, t = sum(own.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
    rows = []
    for doc_id, text in docs:
        words, found = features(text, grams)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, len(words) >= least])
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = drawn[: len(drawn) * percent // 100]
    rank = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted((tuple(r[:4]) + (rank.get(id(r)),) for r in rows), key=repr)


def some_docs(n, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ärger", "naïve", "ΑΒΓ", "x_y", "İstanbul"]
    docs = []
    for i in range(n):
        size = rnd.choice([0, 5, 19, 20, 21, 60, 200])
        docs.append((i, rnd.choice([" ", "\n", "--"]).join(rnd.choices(words, k=size))))
    return docs


def run(spark, docs, target, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted((tuple(r) for r in resample.resample(d, t, **kw).collect()), key=repr)


@pytest.mark.parametrize("grams", [1, 3])
def test_equals_brute_force(spark, monkeypatch, grams):
    monkeypatch.setattr(resample, "FEW", 8)  # so that the medians do the work
    docs, target = some_docs(300), [t for _, t in some_docs(20, 2)]
    assert run(spark, docs, target, grams=grams, percent=37) == brute(docs, target, grams=grams, percent=37)


def test_null_empty_repeated_and_tied_rows(spark, monkeypatch):
    monkeypatch.setattr(resample, "FEW", 2)
    text = " ".join(f"word{i}" for i in range(30))
    docs = [(1, None), (2, ""), (None, text), (None, text), (3, text), (3, text), (3, text + " more"), (4, "Short"), *((7, text) for _ in range(40)), *some_docs(30)]
    for percent in (0, 10, 50, 100):
        assert run(spark, docs, ["word1 word2", None, ""], percent=percent) == brute(docs, ["word1 word2", None, ""], percent=percent)


def test_empty_tables_and_clashing_columns(spark):
    assert run(spark, [], ["a"]) == []
    docs = some_docs(40)
    assert run(spark, docs, [], percent=50) == brute(docs, [], percent=50)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("rank", "score", "buckets", "down", "none", "id", "n_words", "part"):
        d = d.withColumn(name, F.lit("x"))
    t = spark.createDataFrame([("w1",)], "text string").withColumn("counts", F.lit(1))
    assert sorted((tuple(r) for r in resample.resample(d, t).collect()), key=repr) == brute(docs, ["w1"])


def test_very_long_text_is_walked_in_pieces(spark, monkeypatch):
    text = ("Alpha beta, gamma " * 50_000) + "Z" * 100_000 + " end"
    whole = bags.word_counts(text.encode())
    three = bags.run_counts(text.encode(), 3)
    monkeypatch.setattr(bags, "PIECE", 1000)
    assert bags.word_counts(text.encode()) == whole
    assert bags.run_counts(text.encode(), 3) == three
    assert run(spark, [(1, text)], ["alpha"], percent=100) == brute([(1, text)], ["alpha"], percent=100)


@pytest.mark.parametrize("parts", [1, 7])
def test_kth_key_equals_sorting(spark, monkeypatch, parts):
    monkeypatch.setattr(resample, "FEW", 4)
    monkeypatch.setattr(resample, "CHUNK", 50)
    rnd = random.Random(parts)
    keys = [(rnd.choice([-3, -2, 5]), rnd.randint(0, 1), rnd.randint(-20, 20)) for _ in range(400)] + [(5, 0, 1)] * 300
    table = spark.createDataFrame(keys, "down long, none long, id long").repartition(parts)
    for k in (1, 2, 350, 500, 699, 700):
        assert resample.kth_key(table, k) == sorted(keys)[k - 1]
