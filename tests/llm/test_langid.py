"""Language ID: a brute-force version, held-out accuracy, each kind of evidence, rejects."""

import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import langid

SF = "/root/testdata/sf0.01"


def test_evidence_from_markup_and_addresses(spark):
    rows = [
        ('<!DOCTYPE html><HTML class="x" Lang="fr-CA"><p lang="de">', "http://a.example.com/es/1"), ("<p>x</p>", "https://b.example.fr/enx/"), (None, None), ("<html lang=en>", "x"), ("<html data-lang='de'>", "http://c.org/de"),
    ]
    df = spark.createDataFrame(rows, "html string, url string")
    got = df.select(langid.markup_language(F.col("html")), langid.address_language(F.col("url"), ["de", "en", "es", "fr"]), langid.host_of(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("fr", "es", "a.example.com"), (None, "fr", "b.example.fr"), (None, None, None), ("en", None, "x"), (None, "de", "c.org")]


def brute(rows, languages):
    """[(language, probability)] of rows (text, declared, address, host), counted document by document."""
    classes = [*languages, "other"]

    def grams(text):
        b = (text or "").lower().encode()
        return Counter(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % 2**32) >> (32 - langid.BITS) for i in range(len(b) - 2))

    texts = [grams(r[0]) for r in rows]
    model = {x: Counter() for x in languages}
    for (_, declared, _, _), g in zip(rows, texts, strict=True):
        if declared in model:
            model[declared].update(g)
    scores, votes = [], []
    for (_, declared, _, _), g in zip(rows, texts, strict=True):
        each = []
        for x in languages:
            own = g if x == declared else Counter()
            total = (1 << langid.BITS) / 2 + model[x].total() - own.total()
            each.append(sum(n * math.log((model[x][k] - own[k] + 0.5) / total) for k, n in g.items()))
        each.append(-langid.BITS * math.log(2) * g.total())
        scores.append(each)
        votes.append(classes[each.index(max(each))] if g else None)

    def right(column):
        seen = [(r[column], v) for r, v, g in zip(rows, votes, texts, strict=True) if r[column] in languages and g.total() >= langid.CLEAR]
        share = (sum(c == v for c, v in seen) + langid.BELIEF * langid.BELIEF_ROWS) / (len(seen) + langid.BELIEF_ROWS)
        return min(langid.MOST_TRUST, max(1 / len(classes), share))

    trust = right(1), right(2)
    out = []
    for i, (row, each, g) in enumerate(zip(rows, scores, texts, strict=True)):
        prior = [1 / len(classes)] * len(classes)
        host = row[3] or ""
        for level in (lambda h: "", lambda h: ".".join(h.split(".")[-2:]), lambda h: h):
            near = Counter(v for j, (r, v) in enumerate(zip(rows, votes, strict=True)) if j != i and v and level(r[3] or "") == level(host))
            prior = [(near[x] + langid.SHRINK * p) / (near.total() + langid.SHRINK) for x, p in zip(classes, prior, strict=True)]
        logs = [langid.TEMPER * t + math.log(p) for t, p in zip(each, prior, strict=True)]
        for claim, good in zip(row[1:3], trust, strict=True):
            if claim in languages:
                logs = [s + math.log(good if x == claim else (1 - good) / len(languages)) for s, x in zip(logs, classes, strict=True)]
        top = max(logs)
        out.append((classes[logs.index(top)] if g else "und", 1 / sum(math.exp(s - top) for s in logs)))
    return out


def same(got, want):
    assert [r.language for r in got] == [w[0] for w in want]
    assert [r.probability for r in got] == pytest.approx([w[1] for w in want], rel=1e-6)


def corpus(spark):
    de, en = "der hund und die katze gehen nicht über die straße %d", "the dog and the cat do not cross the street %d"
    rows = [(i, (de if i % 2 else en) % (i * 7919 % 1000) * (1 + i % 3), "de" if i % 2 else "en", "h%d.x.org" % (i % 2)) for i in range(400)]
    rows += [(1000, "the dog and the cat", None, None), (1001, "", "en", "h0.x.org"), (1002, None, None, None), (None, "ab", "xx", "h9.q"), (1003, "съешь ещё этих мягких французских булок " * 5, None, "h0.x.org"), (1004, "die katze", "en", "h1.x.org"), (1005, "the cat", "en", "h0.x.org")]
    rows += [rows[0], rows[0]]
    return spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, Key string")


def test_small_corpus(spark):
    docs = corpus(spark)
    got = langid.identify(docs, F.col("text"), F.col("lang"), F.lit(None), F.col("source"), languages=("de", "en")).collect()
    by = {r.id: r for r in got}
    assert len(got) == docs.count()
    assert all(by[i].language == ("de" if i % 2 else "en") and by[i].kept for i in range(400))
    assert by[1000].language == "en" and by[1004].language == "de" and by[1005].language == "en"
    assert [by[i].language for i in (1001, 1002, None)] == ["und"] * 3 and not by[1001].kept
    assert by[1003].language == "other" and not by[1003].kept
    assert langid.identify(docs.limit(0), F.col("text"), F.col("lang"), F.lit(None), F.col("source")).count() == 0


def test_hosts_and_claims_decide_where_text_is_silent(spark):
    docs = corpus(spark).unionByName(spark.createDataFrame([(2000, "999", None, "h0.x.org", 1, ""), (2001, "999", None, "h1.x.org", 1, ""), (2002, "999", None, "new.x.org", 1, "")], "doc_id long, text string, lang string, source string, n_chars long, Key string"))
    by = {r.id: r.language for r in langid.identify(docs, F.col("text"), F.col("lang"), F.when(F.col("doc_id") == 2002, "de"), F.col("source"), languages=("de", "en")).collect()}
    assert (by[2000], by[2001], by[2002]) == ("en", "de", "de")


def test_brute_force(spark):
    rows = sorted((tuple(r) for r in corpus(spark).where("doc_id IS NOT NULL").distinct().collect()), key=lambda r: r[0])
    rows += [(3000 + i, "un perro y un gato %d" % i * (i % 9), ["es", "es", "de", None][i % 4], ["h0.x.org", "a.y.com", "b.y.com", None][i % 3], 1, "") for i in range(40)]
    rows += [(4000, "der hund und die katze " * 9_000, "de", "one.z.net", 1, "")]  # alone on its host, and long
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Key string")
    address = F.when(F.col("doc_id") % 3 == 0, "en").when(F.col("doc_id") % 3 == 1, "de")
    got = langid.identify(docs, F.col("text"), F.col("lang"), address, F.col("source")).orderBy("id").collect()
    languages = langid.languages_of(docs, F.col("lang"))
    assert languages == ["de", "en", "es"]  # one label xx is too few
    same(got, brute([(r[1], r[2], {0: "en", 1: "de"}.get(r[0] % 3), r[3]) for r in rows], languages))


def test_pages_by_brute_force(spark):
    words = {"de": "der hund und die katze gehen nicht über die straße", "en": "the dog and the cat do not cross the street", "fr": "le chien et le chat ne traversent pas la rue"}
    rows = []
    for i in range(150):
        lang = ["de", "en", "fr"][i % 3]
        tag = ["<html lang='%s'>" % lang, "<html lang='en'>", "<html>"][i // 3 % 5 % 3]
        rows.append((i, "http://%s.site%d.org/%s/%d" % ("abc"[i % 3], i % 2, lang if i % 4 else "en", i), tag + "<script>var the = 1</script><p>" + (words[lang] + " %d " % i) * (i % 5) + "</p>", "x"))
    rows += [(200, None, None, "x"), (201, "", "<html lang='en'>", "x"), (202, "http://a.site0.org/", "<p>x", "x"), (203, "nothing", words["de"], "x"), (203, "nothing", words["de"], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Host string")
    evidence, languages = langid.page_evidence(pages)
    assert languages == ["de", "en", "fr"]
    seen = pages.select("page_id", *evidence).orderBy("page_id").collect()
    got = langid.identify_pages(pages).orderBy("page_id").collect()
    assert [r.page_id for r in got] == [r[0] for r in rows]
    same(got, brute([tuple(r)[1:] for r in seen], languages))
    assert langid.identify_pages(pages.limit(0)).count() == 0


def test_labels_make_the_languages(spark):
    tags = ["en"] * 300 + ["EN-us", " pt_BR", "pt", "x", "", None, "english", "de "] + ["pt"] * 4 + ["de"]
    docs = spark.createDataFrame([(t,) for t in tags], "lang string")
    assert langid.languages_of(docs, langid.primary_subtag(F.col("lang"))) == ["de", "en", "pt"]
    assert langid.languages_of(docs, F.col("lang")) == ["en", "pt"]
    assert langid.languages_of(docs.limit(0), F.col("lang")) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_held_out_accuracy_and_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = docs.withColumn("declared", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))  # a third is neither declared nor trained on
    got = langid.identify(hidden, F.col("text"), F.col("declared"), F.lit(None), F.col("source")).join(docs.select("doc_id", "lang"), F.col("id") == F.col("doc_id"))
    held = got.where("doc_id % 3 = 0").agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.avg(F.col("kept").cast("int"))).first()
    assert held[0] > 0.97 and held[1] > 0.99
    kept = langid.keep_languages(docs)
    assert kept.columns == docs.columns and kept.count() > 0.99 * docs.count()
