"""Texts made so that sums of powers collide: the same results as the libraries and brute force."""

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken
import tokenizers

from strata.llm import bpe, decontam, langid, neardup, textops, tokencount
from tests.llm.test_neardup import brute as near_brute


def morse(bits):
    """A Thue-Morse word of 2**bits letters, and its complement."""
    ones = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("az"[b] for b in ones), "".join("za"[b] for b in ones)


ALL = [w for bits in range(8, 14) for w in morse(bits)]


def test_pretokens_with_one_hash_under_powers():
    one, two = morse(10)
    codes = lambda w: textops.mix(np.frombuffer(w.encode(), np.uint8).astype(np.uint64) + np.uint64(1))
    ends = np.array([1024])
    assert textops.rolling_hashes(codes(one), ends - 1024, ends) == textops.rolling_hashes(codes(two), ends - 1024, ends)  # so they are made
    assert textops.slice_hashes(codes(one), ends - 1024, ends) != textops.slice_hashes(codes(two), ends - 1024, ends)
    encoder = bpe.Encoder(path := P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(path).rank, special_tokens={})
    flat, counts = encoder.encode(ALL)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [library.encode_ordinary(w) for w in ALL]
    counter = tokencount.Counter(P.path("byte_bpe_50k.json"))
    other = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert counter.count(ALL).tolist() == [len(other.encode(w, add_special_tokens=False).ids) for w in ALL]


def test_pretokens_that_share_a_key_are_told_apart(monkeypatch):
    """With a hash that nearly always collides, results stay right."""
    monkeypatch.setattr(textops, "slice_hashes", lambda codes, starts, ends, seed=0: (ends - starts).astype(np.uint64) % np.uint64(3))
    texts = ["the cat sat on the mat, again and again", "a dog sat; 12345 abc 'll", "", "the mat the cat"]
    encoder = bpe.Encoder(path := P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(path).rank, special_tokens={})
    for _ in range(2):
        flat, counts = encoder.encode(texts)
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [library.encode_ordinary(w) for w in texts]
    counter = tokencount.Counter(P.path("byte_bpe_50k.json"))
    other = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert counter.count(texts).tolist() == [len(other.encode(w, add_special_tokens=False).ids) for w in texts]


def test_near_duplicates_and_leaks_of_such_words(spark):
    rows = [(i, w) for i, w in enumerate(ALL)] + [(50, "x " + ALL[4] + " y " + ALL[5]), (51, "x " + ALL[5] + " y " + ALL[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.cluster(docs, 3, 85).collect())
    assert got == sorted(near_brute(rows, 3, 85))
    items = spark.createDataFrame([(1, ALL[4]), (2, ALL[9])], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} >= {(4, 1), (9, 2)}
    assert not {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} & {(5, 1), (8, 2)}


@pytest.mark.parametrize("stage", ["language", "near", "leaks"])
def test_stages_with_clashing_columns(spark, stage):
    docs = spark.createDataFrame(
        [(i, f"the quick brown fox number {i} jumps over the lazy dog and runs away from it", "en", "a", "s", "t", "u") for i in range(4)],
        "doc_id long, text string, lang string, source string, _keep_id string, _bad_id string, _Bad_Key string",
    )
    items = spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string")
    run = {"language": lambda d: langid.keep_languages(d), "near": lambda d: neardup.keep_one(d, 5, 80), "leaks": lambda d: decontam.without_leaks(d, items)}[stage]
    out = run(docs)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
