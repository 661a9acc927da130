"""URL rules against a check of every rule on every url."""

import random
import re

import duckdb
import pytest

from strata.llm import queries, urlrules

FIXED = list(queries.URL_RULES)
URLS = [
    None, "", "no scheme", "http://", "http://example.org", "HTTP://EXAMPLE.ORG/en/1", "http://blog.Example.org/es/9?x=/de/", "http://org/", "http://borg/", "x://org?/", "http://org#/",
    "http://notexample.org/es/", "http://a.b.example.org/en/123#t", "http://example.org/en/2", "http://example.com/fr/", "http://com/de/1", "http://example.com/fr", "http://example.com./fr/", "http://example.com:80/fr/",
    "http://a://b.org/x", "https://..org//", "https://É.org/é", "http://example.org/es/" + "x" * 5000,
]


def brute(url, rules, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    whole = re.match(r"[^?#]*", rest).group()
    host = re.match("[^/]*", whole).group()
    path = whole[len(host) :]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, otherwise))
    return host, path, best[3], best[4]


def rows(df):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, URLS[5], "h", "r"), (4, URLS[4], "h", "r")], "page_id long, url string, host string, Rule string")
    got = rows(urlrules.judge(pages, urlrules.rule_table(pages, FIXED)))
    assert got == sorted([(p.page_id, *brute(p.url, FIXED)) for p in pages.collect()], key=str)
    assert urlrules.judge(pages.limit(0), urlrules.rule_table(pages, FIXED)).count() == 0
    none = urlrules.judge(pages, urlrules.rule_table(pages, FIXED).limit(0), otherwise="block")
    assert {r.verdict for r in none.collect()} == {"block"}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_nested_rules_and_hot_hosts(spark, seed, monkeypatch):
    monkeypatch.setattr(urlrules, "PARTS", 16)
    rng = random.Random(seed)
    hosts = ["org", "a.org", "b.a.org", "c.b.a.org", "net", "x.net", "y.x.net", "zx.net"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/bc", "/b", "/ab", "/a/b/c"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(30))}.values())
    urls = ["http://" + rng.choice(hosts[:3] * 4 + hosts + ["q.b.a.org", "com"]) + rng.choice(paths) + rng.choice(["", "?q", "#a", "d", "/"]) for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = rows(urlrules.judge(pages, urlrules.rule_table(pages, rules)))
    assert got == sorted([(i, *brute(u, rules)) for i, u in enumerate(urls)], key=str)


def test_too_many_numbers_of_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "DEPTHS", 2)
    pages = spark.createDataFrame([(1, "http://a.b.c/")], "page_id long, url string")
    rules = [("block", "c", "/"), ("allow", "b.c", "/")]
    assert [r.verdict for r in urlrules.judge(pages, urlrules.rule_table(pages, rules)).collect()] == ["allow"]
    with pytest.raises(ValueError, match="numbers of labels"):
        urlrules.judge(pages, urlrules.rule_table(pages, [*rules, ("allow", "a.b.c", "/")]))


def test_sql_says_the_same():
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    cur = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.URL_SQL})")
    assert sorted(cur.fetchall(), key=str) == sorted([(i, *brute(u, FIXED)) for i, u in enumerate(URLS)], key=str)
