"""BPE ids and token counts against the libraries themselves."""

import base64
import functools
import hashlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers as P
from strata.llm import bpe, textops, tokencount

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@functools.cache
def libraries():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), Tokenizer.from_file(JSON)


@pytest.fixture
def library():
    return libraries()[0]


@pytest.fixture
def counts_library():
    return libraries()[1]


CASES = [
    "", " ", "  ", "\n", "a", "it's we'll 'tis don't I'd 've 'x ''s 's's 're' \n's  's", "a  b   c \n\n d  ", "x" * 300, "ab" * 200 + "é" * 90,
    "1234 5678x9 ٣½", "café naïve 你好 \U0001f600\U0001f468‍\U0001f469", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>  ", "   x 　　y\u0085\u001c\u001dz",
    "tabs\t\tand\r\n\r\nlines \t x", "aaaaaaaaaaaaaaaaaaa  " * 9, "'", "''", "'ll", "’s don’t", "The quick brown fox. " * 40, "﻿​\u0000\u0001",
]


def test_every_code_point_splits_as_the_library(library):
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    texts = ["".join(points[i : i + 3000]) for i in range(0, len(points), 3000)] + ["x" + c + "1" for c in points[:0x3100]]
    encoder = bpe.Encoder(RANKS)
    flat, counts = encoder.encode(texts)
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert flat[at : at + n].tolist() == library.encode_ordinary(text)
        at += n


def test_cases(library, counts_library):
    encoder, counter = bpe.Encoder(RANKS), tokencount.Counter(JSON)
    flat, counts = encoder.encode(CASES)
    at = 0
    for text, n in zip(CASES, counts, strict=True):
        own = flat[at : at + n]
        assert own.tolist() == library.encode_ordinary(text)
        assert encoder.decode(own) == text.encode()
        at += n
    assert counter.count(CASES).tolist() == [len(x.ids) for x in counts_library.encode_batch(CASES, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abest'dlrv  \n\t é1½!.,日😀<|>endoftx"), max_size=60) | st.text(max_size=40), max_size=6))
def test_random(texts):
    library, other = libraries()
    flat, counts = bpe.Encoder(RANKS).encode(texts)
    assert flat.tolist() == [i for t in texts for i in library.encode_ordinary(t)]
    assert counts.tolist() == [len(library.encode_ordinary(t)) for t in texts]
    assert tokencount.Counter(JSON).count(texts).tolist() == [len(other.encode(t, add_special_tokens=False).ids) for t in texts]


def test_long_texts_are_cut_without_a_trace(library, monkeypatch):
    text = ("Some words, and more's to come.  \n\nNext 12 " * 400).strip()
    monkeypatch.setattr(textops, "BLOCK", 64)
    assert "".join(textops.chunks(text, 64)) == text
    parts = [p for c in textops.chunks(text, 64) for p in library.encode_ordinary(c)]
    assert parts == library.encode_ordinary(text)


def test_operators(spark):
    rows = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, None, None), (3, "again", "y"), (3, "again", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    got = bpe.encode(docs, RANKS, ids=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    back = {r.doc_id: r for r in bpe.decode(got, RANKS).collect()}
    for i, text in enumerate(CASES):
        if i != 3:
            assert back[i].text == text
            assert back[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert back[None].n_tokens == 0 and back[None].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert got.count() == len(rows)
    counted = tokencount.token_counts(docs, JSON, 30)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    by = {r.doc_id: r for r in counted.collect()}
    assert by[None].n_tokens == 0 and not by[None].over_limit
    assert by[7].n_bytes == 300 and by[18].over_limit is False and by[7].over_limit
    empty = docs.limit(0)
    assert bpe.encode(empty, RANKS).count() == 0 and tokencount.token_counts(empty, JSON, 3).count() == 0
