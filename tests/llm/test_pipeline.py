"""The pipeline against a brute-force version of each stage, and the registered queries."""

import hashlib
import os

import duckdb
import pytest

import corpus_pipeline as C
import public_tokenizers as P
from strata.llm import bpe, langid, queries, secrets
from tests.llm.test_neardup import brute as near_brute

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_and_names():
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "decontaminate", "secret_scan", "encode"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES if q.startswith("op")}
    assert "pipeline" in queries.QUERIES


@needs_tables
def test_every_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    first = C.language_id(spark, docs, SF)
    assert first.columns == columns
    kept = {r.doc_id for r in first.collect()}
    judged = {r.doc_id: r for r in langid.identify_documents(docs).collect()}
    assert kept == {i for i, r in judged.items() if r.kept}
    assert sum(judged[i].language == rows[i].lang for i in rows) >= 0.98 * len(rows)

    second = C.near_dedup(spark, first.cache(), SF)
    assert second.columns == columns
    want = {r[0] for r in near_brute([(i, rows[i].text) for i in sorted(kept)], C.SHINGLE, C.PERCENT) if r[3]}
    assert {r.doc_id for r in second.collect()} == want

    third = C.decontaminate(spark, second.cache(), SF)
    assert third.columns == columns
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in third.collect()}
    held = {i for i in want if any(x in " ".join(rows[i].text.lower().split()) for x in items)}
    assert not held & left and len(want - left) <= len(held) + 2

    fourth = C.secret_scan(spark, third.cache(), SF)
    assert fourth.columns == columns and {r.doc_id for r in fourth.collect()} == left
    assert secrets.report(fourth).where("n_assign + n_access + n_hex > 0").count() == 0
    for r in fourth.collect():
        assert r.text == rows[r.doc_id].text or "[SECRET]" in r.text and r.n_chars == len(r.text)

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = bpe.ranks(path)
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    texts = {r.doc_id: r.text for r in fourth.collect()}
    for r in C.encode(spark, fourth, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_tables_and_nulls(spark, scratch):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{scratch}/a/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{scratch}/a/benchmark.parquet")
    assert C.run(spark, f"{scratch}/a").count() == 0
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (2, None, "en", "a", None), (3, "", None, "a", 0), (4, "its secret: abcdefgh123, said the dog", "en", None, 3)]
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/b/documents.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{scratch}/b/benchmark.parquet")
    got = {r.doc_id: r for r in C.run(spark, f"{scratch}/b").collect()}
    assert set(got) == {1, 4}
    assert got[4].decoded_sha256 == hashlib.sha256(b"its [SECRET], said the dog").hexdigest()


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(names).collect()), key=str) == sorted(cur.fetchall(), key=str)
