"""From raw documents to token ids.

``STAGES`` in order: language ID, near-dedup, decontamination, secret scan,
encoding. Each is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next one's ``docs``, so a lost executor costs the
stage at hand only. All but the last return the columns of ``documents``.

- ``language_id`` drops documents in no language of the model, or without text.
- ``near_dedup`` keeps one document, the one with the smallest id, of every group
  linked by sets of five-word shingles with a similarity of 0.8 or more.
- ``decontaminate`` drops documents that hold a benchmark item of five words or more.
- ``secret_scan`` replaces secrets in the texts and keeps all documents.
- ``encode`` returns token ids, with digests of them and of the bytes that they
  decode to.

Nulls: a null text has no language and is dropped by the first stage; rows with
a null id pass, in near-dedup as ``neardup.keep_one`` has it. Empty tables pass
through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontam, langid, neardup, secrets
from strata.llm.tables import staged, table

SHINGLE, PERCENT = 5, 80
#: Words of the shortest benchmark item that drops a document, one shingle; a shorter one is a phrase that clean documents hold too.
MIN_ITEM_WORDS = SHINGLE


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, SHINGLE, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"), min_item_words=MIN_ITEM_WORDS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secret_scan", secret_scan), ("encode", encode)]

#: SQL can express neither the sketches nor the merges; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
