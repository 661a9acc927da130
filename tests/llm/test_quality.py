"""Quality rules: base figures against Python, cutoffs against exact binomial sums."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base_figures(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "x " * 500, "é😀 ##|\n\nsame line\n same line\nsame line\n\x0b\x0c\r", "a b c d e " * 3 + "f", "a a a a a a", "\x1c \x85 \xa0"]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(150)]
    texts += ["\n".join(" ".join(rng.choice(["one", "two", "three#"]) for _ in range(3)) for _ in range(rng.randrange(30))) for _ in range(60)]
    texts += [" ".join("w%d" % rng.randrange(4000) for _ in range(30_000))]
    docs = spark.createDataFrame([(i, t, None, "w") for i, t in enumerate(texts)], "doc_id long, text string, lang string, Words string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for r in quality.judge(docs, labels).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert r.kept == (not r.base_failed)  # without labels nothing is shown to be safe


def at_most(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_sums(spark):
    rows = [(k, n) for n in (1, 10, 400, 1000) for k in (0, 1, 2, 5, 9) if k < n]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", quality.log_at_most(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for r in got:
        want = at_most(r.k, r.n, 0.02)
        assert math.exp(r.p) == pytest.approx(want if r.k < 0.02 * r.n else 1.0, rel=1e-9)


def corpus(spark, n=7200):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        words = ["w%d" % rng.randrange(9000) + ("" if good else "##") for _ in range(40)]
        rows.append((i, " ".join(words), "xy"[i // 4 % 2], 1))
        if i % 3:
            labels.append((i, int(good)))
    labels += [(10**6, 1), (None, 1), (5, None), (1, 0)]
    rows += [(None, rows[4][1], None, 1), (10**7, None, "x", 1), rows[2], rows[2]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, stratum int"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_are_safe_and_useful(spark):
    docs, labels = corpus(spark)
    got = quality.judge(docs, labels)
    rows = got.collect()
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert len(rows) == docs.count()
    bad = [r for r in rows if r.doc_id is not None and r.doc_id < 7200 and r.doc_id % 4 == 0]
    good = [r for r in rows if r.doc_id is not None and r.doc_id < 7200 and r.doc_id % 4 > 0]
    assert not any(r.kept for r in bad)
    assert sum(not r.kept for r in good) <= quality.RISK * len(good)
    assert [r.kept for r in rows if r.doc_id is None] == [True]  # no labels in its stratum
    few = quality.judge(docs, labels.where("doc_id < 100"))
    assert few.where("NOT kept AND NOT base_failed").count() == 0
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_each_cutoff_passes_its_test(spark):
    docs, labels = corpus(spark)
    part = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("stratum"), F.coalesce("text", F.lit("")).alias("text"))
    scored = quality.measured(part).where("NOT base_failed")
    good = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("q")).where("q = 1")
    held = scored.join(good.select("id"), "id", "left_semi")
    found = {(r.stratum, r.score): r.cutoff for r in quality.cutoffs(held).collect()}
    tests = 2 * sum(map(len, quality.GRIDS.values()))
    counted = held.collect()
    for stratum in "xy":
        values = [r.n_symbols / max(1, r.word_chars) for r in counted if r.stratum == stratum]
        passed = [c for c in quality.GRIDS["symbols"] if at_most(sum(v > c for v in values), len(values), quality.RISK / 4) <= quality.ERROR / tests]
        assert found.get((stratum, "symbols")) == min(passed, default=None)
