"""Suffix sorting, and substring dedup against brute force over all strings."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import suffixdedup
from strata.llm.gsaca import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 6).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60)))
def test_suffix_array(symbols):
    assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_array_of_long_sequences():
    rng = random.Random(1)
    for symbols in ([0] * 3000, [1, 0] * 1500, [rng.randrange(2) for _ in range(4000)], list(range(3000, 0, -1)), list(range(3000))):
        assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i, s=symbols: s[i:])


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé\0") for _ in range(rng.randrange(1, 4)))
    make = lambda n: " ".join(word() for _ in range(n))
    passages = [make(n) for n in (2, length // 4, length // 2, length)]
    texts = [None, "", "a", "x" * (length - 1), "x" * length, "y" * (length + 1), "ab" * 3 * length]
    for _ in range(60):
        texts.append("".join(rng.choice([make(rng.randrange(40)), rng.choice(passages)]) for _ in range(rng.randrange(1, 5))))
    texts += [texts[10], texts[10], texts[11], texts[12][3:], "z" + texts[13]]
    return texts


def check(spark, texts, length, gram):
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, Digest binary")
    got = {r.doc_id: tuple(r)[1:] for r in suffixdedup.dedup(docs, length, gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_production_length(spark):
    check(spark, corpus(1, 200), 200, 64)


@pytest.mark.parametrize("hot,map_grams,small,part", [(4096, 1 << 24, 10, 5), (2, 1 << 24, 0, 5), (4096, 0, 10, 50)])
def test_short_strings_on_every_path(spark, monkeypatch, hot, map_grams, small, part):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "MAP_GRAMS", map_grams)
    monkeypatch.setattr(suffixdedup, "SMALL", small)
    check(spark, corpus(2, 24), 24, 7)


def test_long_texts_in_pieces(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    raw = __import__("numpy").frombuffer(text.encode(), "u1")
    at = __import__("numpy").array([0, 0, len(raw), len(raw)])
    whole = suffixdedup.anchors(raw, at, 24, 7)
    old = suffixdedup._pieces
    starts = lambda found: sorted((int(h), int(p) - d) for _, h, p, a, b in zip(*found, strict=True) for d in range(a, b + 1))
    try:
        suffixdedup._pieces = lambda raw, at, length: old(raw, at, length, 100)
        assert starts(suffixdedup.anchors(raw, at, 24, 7)) == starts(whole)
    finally:
        suffixdedup._pieces = old


def test_odd_tables(spark):
    same = "word " * 50 + "".join(chr(97 + i % 26) * 9 for i in range(30))
    docs = spark.createDataFrame([(1, same), (1, same), (None, same), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed, r.n_spans) for r in suffixdedup.dedup(docs).collect())
    assert got == [("1", len(same), 1), ("1", len(same), 1), ("None", 0, 0), ("None", len(same), 1)]
    assert suffixdedup.dedup(docs.limit(0)).count() == 0


def test_a_hot_gram_between_many_contexts(spark, monkeypatch):
    """Passages shorter and longer than a string in many documents, with other text around each."""
    monkeypatch.setattr(suffixdedup, "HOT", 6)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passages = [noise(n) for n in (20, 23, 24, 30, 60)]
    texts = [noise(rng.randrange(30)) + rng.choice(passages) + noise(rng.choice([0, 1, 2, 30])) for _ in range(150)]
    texts += [passages[0] + noise(3)] * 9 + [noise(2) + passages[1]] * 5
    check(spark, texts, 24, 7)
