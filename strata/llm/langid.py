"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as log-likelihoods of each language:

- text: byte trigrams, with a model counted from the documents' declared
  languages, tempered because neighbouring trigrams depend on one another;
- the declared markup language, and the suffix or a path part of the address: each
  is right as often as it agrees with the text's own verdict on clear texts;
- the host's prior: languages that the text alone gives to the host's documents,
  shrunk toward those of its domain, which are shrunk toward the whole corpus.

No document is evidence about itself twice: its own trigrams are taken out of the
model of its declared language, and its own verdict out of all three counts of
the prior.

The languages are those of the labels, see ``languages_of``. A further class,
``other``, holds every trigram equally likely, so that text in no language of the
model goes there.

What goes to all tasks is the trigram table, of 256 kB a language whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.tables import fresh, small_batches, staged, text_of

#: Share of the labelled documents that makes a language one of the model's, so it has 200 at most.
SHARE = 0.005
#: Trigrams are hashed to this many bits.
BITS = 15
#: How often a claim is right before any is seen, and the documents this belief counts for.
BELIEF, BELIEF_ROWS = 0.9, 20.0
#: A claim is trusted this far at most, and not less than a guess among all classes.
MOST_TRUST = 0.99
#: Trigrams from which a text's own verdict tells whether a claim is right.
CLEAR = 100
#: Weight of a trigram among three that overlap.
TEMPER = 1 / 3
#: Documents that a host's domain, and a domain's corpus, count for in its prior.
SHRINK = 20.0


def markup_language(html: Column) -> Column:
    """The primary subtag of ``<html lang="...">``, lower-cased, or null."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    return F.when(found != "", found)


def primary_subtag(tag: Column) -> Column:
    """``en`` of ``en``, ``EN`` or ``en-US``; null for what is no language tag."""
    found = F.lower(F.regexp_extract(tag.cast("string"), r"^\s*([A-Za-z]{2,3})(?:[-_].*|\s*)$", 1))
    return F.when(found != "", found)


def languages_of(docs: DataFrame, declared: Column) -> list[str]:
    """Languages of two or three letters with at least ``SHARE`` of the rows that declare one, sorted."""
    counts = docs.select(declared.alias("language")).where(F.col("language").rlike("^[a-z]{2,3}$")).groupBy("language").agg(F.count("*").alias("n"))
    rows = counts.collect()  # 26**2 + 26**3 at most
    return sorted(r.language for r in rows if r.n >= SHARE * sum(x.n for x in rows))


def address_language(url: Column, languages: Sequence[str]) -> Column:
    """A language named by the first path part (``/fr/``) or by the host's last label (``.fr``), or null."""
    some = "|".join(languages)
    path = F.regexp_extract(url, rf"^[^:/?#]+://[^/?#]*/({some})(?:[/?#]|$)", 1)
    host = F.regexp_extract(url, rf"^(?:[^:/?#]+://)?[^/?#]*\.({some})(?:[/?#:]|$)", 1)
    return F.when(path != "", path).when(host != "", host)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[^:/?#]+://)?([^/?#]*)", 1))


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers at every byte of the lower-cased texts, and the texts' offsets."""
    raw, at = textops.utf8(pc.utf8_lower(column))
    if len(raw) < 3:
        return np.zeros(0, np.int64), at
    x = raw.astype(np.uint32)
    x = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64), at


def _inner(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of trigrams that lie inside each text."""
    return np.minimum(at[:-1], n), np.minimum(np.maximum(at[1:] - 2, at[:-1]), n)


def _train_batches(languages: Sequence[str]):
    """For mapInArrow over (declared, text): trigram counts by language, one table a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << BITS), np.int64)
        for batch in batches:
            column = batch.column(1).fill_null("")
            label = pc.index_in(batch.column(0), pa.array(list(languages), pa.string())).to_pylist()
            for rows in textops.slices(column):
                grams, at = _features(column[rows])
                los, his = _inner(at, len(grams))
                for k, lo, hi in zip(label[rows], los.tolist(), his.tolist(), strict=True):
                    if k is not None and hi > lo:
                        counts[k] += np.bincount(grams[lo:hi], minlength=1 << BITS)
        which, gram = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(gram, pa.int32()), pa.array(counts[which, gram], pa.int64())], names=["language", "gram", "n"])

    return run


def _score_batches(shared, languages: Sequence[str], keep: int):
    """For mapInArrow: replaces the last column, the text, by its number of trigrams and each class's log-likelihood.

    The declared language is two columns before the text; its model is taken without this text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        totals = table.sum(1)
        model = np.vstack([np.log(table / totals[:, None]), np.full(1 << BITS, -BITS * np.log(2.0))])
        for batch in batches:
            column = batch.column(keep).fill_null("")
            label = pc.index_in(batch.column(keep - 2), pa.array(list(languages), pa.string())).to_pylist()
            n, scores = [np.zeros(0, np.int64)], [np.zeros((0, len(model)))]
            for rows in textops.slices(column):
                grams, at = _features(column[rows])
                lo, hi = _inner(at, len(grams))
                each = np.zeros((len(lo), len(model)))
                for k, logs in enumerate(model):
                    sums = np.zeros(len(grams) + 1)
                    np.cumsum(logs[grams], out=sums[1:])
                    each[:, k] = sums[hi] - sums[lo]
                for i, k in enumerate(label[rows]):
                    if k is not None and hi[i] > lo[i]:
                        own, times = np.unique(grams[lo[i] : hi[i]], return_counts=True)
                        each[i, k] = times @ np.log((table[k, own] - times) / (totals[k] - (hi[i] - lo[i])))
                n.append(hi - lo)
                scores.append(each)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(np.concatenate(n), pa.int64()), pa.array(list(np.concatenate(scores)), pa.list_(pa.float64()))], names=[*batch.schema.names[:keep], "n_grams", "text_score"])

    return run


def _model(spark, labelled: DataFrame, languages: Sequence[str]):
    """Counts of trigrams by language, and a half for each."""
    counts = labelled.mapInArrow(_train_batches(languages), "language int, gram int, n long")
    table = np.full((len(languages), 1 << BITS), 0.5)
    for part in counts.groupBy("language", "gram").agg(F.sum("n").alias("n")).toArrow().to_batches():  # one size at most
        table[part.column(0).to_numpy(), part.column(1).to_numpy()] += part.column(2).to_numpy()
    return spark.sparkContext.broadcast(table)


def _claim(claim: Column, right: float, languages: Sequence[str]) -> Column:
    """Log-likelihoods of a claimed language; none of ours, or null, says nothing."""
    wrong = float(np.log((1 - right) / max(1, len(languages))))
    each = F.array(*[F.when(claim == x, F.lit(float(np.log(right)))).otherwise(F.lit(wrong)) for x in languages], F.lit(wrong))
    nothing = F.array(*[F.lit(0.0)] * (len(languages) + 1))
    return F.when(claim.isin(*languages), each).otherwise(nothing)


def _trust(scored: DataFrame, claims: Sequence[str], verdict: Column, languages: Sequence[str]) -> list[float]:
    """For each column of claims how often it is right, judged by the verdicts on texts of ``CLEAR`` trigrams and more."""
    counts = []
    for claim in claims:
        some = F.col(claim).isin(*languages)
        counts += [F.count(F.when(some, 1)), F.count(F.when(some & (F.col(claim) == verdict), 1))]
    found = list(scored.where(F.col("n_grams") >= CLEAR).agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first())
    shares = [(right + BELIEF * BELIEF_ROWS) / (n + BELIEF_ROWS) for n, right in zip(found[::2], found[1::2], strict=True)]
    return [min(MOST_TRUST, max(1 / (len(languages) + 1), x)) for x in shares]


def identify(
    docs: DataFrame,
    text: Column,
    declared: Column,
    address: Column,
    host: Column,
    id_col: str = "doc_id",
    languages: Sequence[str] | None = None,
    confidence: float = 0.5,
) -> DataFrame:
    """The language of every row, from all evidence; ``languages``: by default those of ``declared``.

    Returns one row per input row: ``id``, ``key`` (a hash of the text),
    ``language`` (one of ``languages``, ``other``, or ``und`` for a text of under
    three bytes or null), ``probability`` and ``kept``: whether it is one of
    ``languages`` with at least ``confidence``. Null evidence says nothing; a
    null host counts as one host. Null and repeated ids pass through, further
    columns aren't read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    languages = languages_of(docs, declared) if languages is None else list(languages)
    classes = [*languages, "other"]
    labelled = docs.select(declared.alias("declared"), F.coalesce(text, F.lit("")).alias("text")).where(F.col("declared").isin(*languages))
    model = _model(spark, labelled, languages)
    part = docs.select(
        docs[id_col].cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), F.coalesce(host, F.lit("")).alias("host"),
        declared.cast("string").alias("declared"), address.cast("string").alias("address"), F.coalesce(text, F.lit("")).alias("text"),
    )
    fields = "id long, key long, host string, declared string, address string, n_grams long, text_score array<double>"

    def best(scores: str) -> Column:
        return F.array_position(F.col(scores), F.array_max(scores)).cast("int")

    # class: the text's own verdict, which is its vote
    scored = part.mapInArrow(_score_batches(model, languages, 5), fields)
    scored = staged(scored.withColumn("class", F.when(F.col("n_grams") > 0, best("text_score"))), "language-scores")
    names = F.array(*map(F.lit, classes))
    declared_right, address_right = _trust(scored, ("declared", "address"), F.element_at(names, F.col("class")), languages)

    # priors: votes by host, domain and corpus
    votes = scored.where("n_grams > 0").groupBy("host", "class").agg(F.count("*").alias("n"))
    votes = votes.withColumn("domain", F.substring_index("host", ".", -2))
    numbers = range(1, len(classes) + 1)
    by_host = votes.groupBy("domain", "host").pivot("class", list(numbers)).agg(F.sum("n")).na.fill(0)
    host_counts = staged(by_host.select("domain", "host", F.array(*[F.col(f"`{k}`").cast("double") for k in numbers]).alias("counts")), "host-counts")

    def summed(*keys: str) -> DataFrame:
        rows = host_counts.groupBy(*keys).agg(*[F.sum(F.col("counts")[k]).alias(f"c{k}") for k in range(len(classes))])
        return rows.select(*keys, F.array(*[F.coalesce(f"c{k}", F.lit(0.0)) for k in range(len(classes))]).alias("sums"))

    def others(counts: Column) -> Column:
        """Without the row's own vote."""
        return F.transform(counts, lambda n, k: n - F.when(k + 1 == F.col("class"), 1.0).otherwise(0.0))

    def shrunk(counts: Column, prior: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(F.arrays_zip(counts.alias("c"), prior.alias("p")), lambda x: (x["c"] + SHRINK * x["p"]) / (total + SHRINK))

    def constant(values: Sequence[float]) -> Column:
        return F.array(*map(F.lit, values))

    corpus = constant(summed().first().sums)
    hosts = host_counts.join(summed("domain"), "domain").select("host", "counts", "sums")
    joined = scored.join(hosts, "host", "left")
    none = constant([0.0] * len(classes))  # a host without any text
    joined = joined.withColumns({"counts": others(F.coalesce("counts", none)), "sums": others(F.coalesce("sums", none)), "all": others(corpus)})
    prior = shrunk(F.col("counts"), shrunk(F.col("sums"), shrunk(F.col("all"), constant([1.0 / len(classes)] * len(classes)))))
    claims = _claim(F.col("declared"), declared_right, languages).alias("d"), _claim(F.col("address"), address_right, languages).alias("a")
    parts = F.arrays_zip(F.col("text_score").alias("t"), prior.alias("p"), *claims)
    joined = joined.withColumn("score", F.transform(parts, lambda x: TEMPER * x["t"] + F.log(x["p"]) + x["d"] + x["a"]))
    joined = joined.withColumn("top", F.array_max("score"))
    total = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    name = F.element_at(names, best("score"))
    out = joined.select("id", "key", F.when(F.col("n_grams") == 0, F.lit("und")).otherwise(name).alias("language"), (1 / total).alias("probability"))
    return out.withColumn("kept", F.col("language").isin(*languages) & (F.col("probability") >= confidence))


def identify_documents(docs: DataFrame) -> DataFrame:
    """``documents``: the declared language is in ``lang``, host and address in ``source``."""
    declared = primary_subtag(F.col("lang"))
    languages = languages_of(docs, declared)
    found = identify(docs, F.col("text"), declared, address_language(F.col("source"), languages), F.col("source"), languages=languages)
    return found.withColumnRenamed("id", "doc_id")


def page_evidence(pages: DataFrame) -> tuple[list[Column], list[str]]:
    """Of ``pages`` the text without tags, the markup's language, those of the address, and the host; and the languages."""
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    declared = markup_language(F.col("html"))
    languages = languages_of(pages, declared)
    return [body, declared, address_language(F.col("url"), languages), host_of(F.col("url"))], languages


def identify_pages(pages: DataFrame) -> DataFrame:
    """``pages``: declared in the markup, address and host from the url, text without tags."""
    evidence, languages = page_evidence(pages)
    found = identify(pages, *evidence, id_col="page_id", languages=languages)
    return found.withColumnRenamed("id", "page_id")


def keep_languages(docs: DataFrame) -> DataFrame:
    """``documents`` without those whose language is rejected; all columns as they are."""
    bad_id, bad_key = fresh(docs, "_bad_id"), fresh(docs, "_bad_key")
    bad = staged(identify_documents(docs).where("NOT kept").select(F.col("doc_id").alias(bad_id), F.col("key").alias(bad_key)).distinct(), "rejected")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_of()) == F.col(bad_key))
    return docs.join(bad, same, "left_anti")
