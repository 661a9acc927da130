"""Near-duplicates against all pairs by brute force."""

import random
import re

import pytest

from strata.llm import neardup
from strata.llm.components import roots

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent):
    """(id, shingles, component, kept) of every row, as a sorted list."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        comp = min(ids, default=None) if sets[i] else id_
        out.append((id_, len(sets[i]), comp, id_ == comp))
    return sorted(out, key=str)


def corpus(seed, n_groups=25):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(4000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    texts = []
    for g in range(n_groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 8, 20, 50, 58, 66, 75, 200, 600]))]
        if g % 4 == 0:
            base = passage + base
        texts.append(base)
        for _ in range(rng.choice([0, 1, 3, 12])):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                k = rng.randrange(len(other) + 1)
                if rng.random() < 0.5:
                    other[k : k + 1] = [rng.choice(vocab)]
                else:
                    other.insert(k, rng.choice(vocab))
            texts.append(other)
    # a chain: each linked with the next only
    chain = [rng.choice(vocab) for _ in range(400)]
    for step in range(8):
        texts.append(chain[step * 12 :] + ["c%d" % i for i in range(step * 12)])
    joined = [rng.choice([" ", "\n", "\t  "]).join(x) for x in texts]
    joined += ["", "  \n ", None, joined[3].upper(), joined[3] + " ", "ÉCOLE été", "école été"]
    rng.shuffle(joined)
    return [(i * 3 + 1, t) for i, t in enumerate(joined)]


@pytest.mark.parametrize("seed,n,percent", [(1, 3, 85), (2, 3, 85), (3, 5, 80)])
def test_against_brute_force(spark, seed, n, percent):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows], "doc_id long, text string, node string, Digest double")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.cluster(docs, n, percent).collect()), key=str)
    assert got == brute(rows, n, percent)


def test_nulls_repeats_and_empty_tables(spark):
    same = "one two three four five six seven eight nine ten"
    rows = [(5, same), (5, same), (None, same), (9, same), (None, "alone in the world"), (None, "alone in the world"), (None, None), (7, None), (7, ""), (8, "x"), (8, "y z")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.cluster(docs, 3, 85).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (None, 5, False), (9, 5, False), (None, None, True), (None, None, True), (None, None, True), (7, 7, True), (7, 7, True), (8, 8, True), (8, 8, True)], key=str)
    kept = neardup.keep_one(docs, 3, 85)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert left.count((5, same)) == 1 and (9, same) not in left and (None, same) not in left
    assert left.count((7, None)) == 1 and left.count((7, "")) == 1 and sum(i == 8 for i, _ in left) == 1
    assert neardup.cluster(docs.limit(0), 3, 85).count() == 0 and neardup.keep_one(docs.limit(0), 3, 85).count() == 0
    words = docs.where("text = '' OR text IS NULL")
    assert neardup.cluster(words, 3, 85).count() == 3


@pytest.mark.parametrize("percent", [80, 85])
def test_crowds(spark, monkeypatch, percent):
    """Many variants of one text, most of them not linked with one another, on the path of long lists."""
    monkeypatch.setattr(neardup, "SHORT", 2)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(9)
    base = ["b%d" % i for i in range(150)]
    rows = corpus(4, 8)
    for i in range(130):
        other = list(base)
        for k in rng.sample(range(150), rng.choice([0, 1, 2, 3, 4, 5, 8])):
            other[k] = "e%d" % rng.randrange(60)
        rows.append((10_000 + i, " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.cluster(docs, 3, percent).collect()), key=str)
    assert got == brute(rows, 3, percent)


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {x: x for p in links for x in p}
    for _ in range(300):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    loops = {a for a, b in links if a == b}
    assert {k: v for k, v in least.items() if k not in loops or k in got} == got
