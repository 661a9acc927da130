"""The registered queries of this package: one for each operator, and the pipeline.

Parameters here are the production ones; each query applies its operator to its
whole table. ``ORACLE`` has SQL where SQL can express a query.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontam, langid, linededup, metricjoin, neardup, quality, resample, search, secrets, suffixdedup, tokencount, urlrules
from strata.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKEN_LIMIT = 1024


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return add


@register("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@register("op2_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.cluster(table(spark, sf_dir, "documents"), shingle=3, percent=85).drop("key")


#: Verdict, host and path of each rule: fixed values of the query's contract.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

URL_SQL = f"""
WITH cut AS (
    SELECT page_id, coalesce(regexp_extract(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '^[^?#]*'), '') AS whole
    FROM pages),
parts AS (
    SELECT page_id, row_number() OVER () AS r, translate(split_part(whole, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           substr(whole, length(split_part(whole, '/', 1)) + 1) AS path
    FROM cut),
rules(verdict, h, p) AS (VALUES {", ".join(map(str, URL_RULES))})
SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
       arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY r"""


@register("op3_url_rules", URL_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlrules.judge(pages, urlrules.rule_table(pages, URL_RULES))


@register("op4_decontaminate")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@register("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)


@register("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


@register("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup(table(spark, sf_dir, "documents"), length=200)


@register("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@register("op10_langid")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents")).drop("key")


RESAMPLE_SQL = """
WITH texts AS (
    SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
    UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
words AS (
    SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
    FROM texts),
bucketed AS (  -- crc32, bit by bit
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
                                 lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)), lambda a, y: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)),
                     4294967295::BIGINT) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM words)),
held AS (SELECT side, r, bucket, count(*) AS n FROM words JOIN bucketed USING (word) GROUP BY ALL),
counts AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM held GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain
    FROM counts),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM held JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
    SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM texts LEFT JOIN weights USING (r) WHERE side = 'd'),
drawn AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN drawn USING (r)"""


@register("op11_resample", RESAMPLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SEARCH_SQL = """
WITH texts AS (
    SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
    UNION ALL SELECT 'i', row_number() OVER (), item_id, text FROM benchmark),
terms AS (
    SELECT side, r, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM texts),
held AS (SELECT side, r, any_value(id) AS id, term, count(*) AS tf FROM terms GROUP BY side, r, term),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM held WHERE side = 'd' GROUP BY r),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
lengths AS (SELECT r, 100 - 50 + ((50 * n * docs) // total) AS m FROM sizes, whole),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, whole WHERE side = 'd' GROUP BY term),
scored AS (
    SELECT i.r AS item, any_value(i.id) AS item_id, d.r, any_value(d.id) AS doc_id, sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 20 * m)))::BIGINT AS score
    FROM held i JOIN held d USING (term) JOIN weights USING (term) JOIN lengths l ON l.r = d.r
    WHERE i.side = 'i' AND d.side = 'd' GROUP BY i.r, d.r)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""


@register("op12_search", SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


EMBEDDING_SQL = """
WITH RECURSIVE doubles AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
vectors AS (
    SELECT r, vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size
    FROM doubles WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS a, b.r AS b, a.vec_id AS low, b.vec_id AS other
    FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reached(r, seen) AS (
    SELECT r, r FROM doubles
    UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.seen),
components AS (SELECT reached.r, min(vec_id) AS component_id FROM reached JOIN doubles ON doubles.r = reached.seen GROUP BY reached.r)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = doubles.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM doubles JOIN components USING (r)"""


@register("op13_embedding_dedup", EMBEDDING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.near_vectors(table(spark, sf_dir, "embeddings"))


@register("langid_pages")
def langid_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(table(spark, sf_dir, "pages")).drop("key")


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
