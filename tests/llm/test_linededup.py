"""Line dedup against brute force."""

import hashlib
import random
import re

from strata.llm import linededup

WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


ATOM_END = re.compile(r"\n|[.!?…]+[\"')]*(?=\s)")


def units(text, min_words, sentence_words):
    """All units of a text, by their definition: (start, end, words)."""
    atoms, at = [], 0
    for m in [*ATOM_END.finditer(text), None]:
        end = len(text) if m is None else m.start() if m[0] == "\n" else m.end()
        atoms.append((at, end, WORD.findall(text[at:end].lower()), m is None or m[0] == "\n", m is not None and m[0] != "\n"))
        at = len(text) if m is None else m.end()
    lines, sentences, paragraphs, line, sentence, paragraph = [], [], [], [], [], []
    for k, atom in enumerate(atoms):
        line.append(atom)
        sentence.append(atom)
        if atom[4]:
            sentences.append(sentence)
            sentence = []
        if atom[3]:
            lines.append(line)
            if any(a[2] for a in line):
                paragraph += line
            else:
                paragraphs.append(paragraph)
                if sentence != line:
                    sentences.append(sentence[: len(sentence) - len(line)])
                paragraph, sentence = [], []
            line = []
    paragraphs.append(paragraph)
    sentences.append(sentence)
    count = lambda group: sum(len(a[2]) for a in group)
    found = [p for p in paragraphs if count(p) >= min_words]
    lines, sentences = [x for x in lines if count(x)], [x for x in sentences if count(x)]

    def windows(parts, least, bound):
        for i, part in enumerate(parts):
            if count(part) >= least:
                found.append(part)
                continue
            for step in (1, -1)[: 1 + bound]:
                j, held = i, count(part)
                while held < least:
                    j += step
                    if not 0 <= j < len(parts) or bound and count(parts[j]) >= least:
                        break
                    held += count(parts[j])
                else:
                    found.append([a for p in parts[min(i, j) : max(i, j) + 1] for a in p])

    windows(lines, min_words, True)
    windows(sentences, sentence_words, False)
    out = set()
    for group in found:
        while not group[0][2]:
            group = group[1:]
        while not group[-1][2]:
            group = group[:-1]
        out.add((group[0][0], group[-1][1], tuple(w for a in group for w in a[2])))
    return sorted(out)


def brute(rows, min_words, sentence_words=12):
    """Removed pieces by input row, rows in order of rank."""
    first, out = {}, {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    every = {k: units(rows[k][1] or "", min_words, sentence_words) for k in order}
    for k in order:
        for lo, hi, words in every[k]:
            first.setdefault(words, (k, lo, hi))
    for k in order:
        text = rows[k][1] or ""
        spans = [(lo, hi) for lo, hi, words in every[k] if first[words][0] != k or lo >= first[words][2]]
        covered = [False] * (len(text) + 1)
        for lo, hi in spans:
            covered[lo:hi] = [True] * (hi - lo)
        pieces, at = [], 0
        while at < len(text):
            if not covered[at]:
                at += 1
                continue
            end = at
            while end < len(text) and covered[end]:
                end += 1
            lo = at
            for m in re.finditer("\n", text[at:end]):
                pieces.append((lo, at + m.start()))
                lo = at + m.end()
            pieces.append((lo, end))
            at = end
        out[k] = pieces
    return out


def corpus():
    rng = random.Random(4)
    lines = [" ".join("w%d" % rng.randrange(500) for _ in range(rng.choice([0, 3, 20, 25, 60]))) for _ in range(40)] + ["é😀 " * 30, "É😀, " * 30]
    rows = [(i * 2, "\n".join(rng.choice(lines) if rng.random() < 0.5 else " ".join("v%d" % rng.randrange(9**9) for _ in range(25)) for _ in range(rng.randrange(9)))) for i in range(80)]
    rows += [(7, lines[5].upper() + "!\n" + lines[6] + "\n"), (9, None), (11, ""), (None, "\n".join(lines))]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    want = brute(rows, 20)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, Row int").coalesce(1)
    got = {r.doc_id: r for r in linededup.remove(docs).collect()}
    assert {rows[k][0] for k, s in want.items() if s} == set(got)
    for k, spans in want.items():
        if spans:
            id_, text = rows[k]
            r = got[id_]
            assert list(zip(r.starts, r.ends, strict=True)) == spans
            left, at = "", 0
            for lo, hi in spans:
                whole = (lo == 0 or text[lo - 1] == "\n") and text[hi : hi + 1] == "\n"
                left, at = left + text[at:lo], hi + whole
            assert r.left == left + text[at:] and r.kept_sha256 == hashlib.sha256(r.left.encode()).hexdigest()
    report = {r.doc_id: r for r in linededup.report(docs).collect()}
    assert all(r.n_removed == len(got[i].starts) and r.spans == ",".join(f"{a}:{b}" for a, b in zip(got[i].starts, got[i].ends, strict=True)) for i, r in report.items())


def prose(rng, n):
    out = []
    for _ in range(n):
        words = ["%s%d" % (rng.choice("abcÉ"), rng.randrange(4000)) for _ in range(rng.choice([1, 2, 5, 9, 14, 30]))]
        out.append(" ".join(words).capitalize() + rng.choice([".", "!", "?", "...", '."', ",", ""]))
    return out


def test_sentences_and_windows_against_brute_force(spark):
    rng = random.Random(12)
    shared = [prose(rng, 9) for _ in range(6)]
    rows = []
    for i in range(70):
        text = prose(rng, rng.randrange(12))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(shared)[rng.randrange(3) :]
        rows.append((rng.choice([i, i, 5]), "".join(x + rng.choice([" ", " ", " ", "\n", "\n\n", "  "]) for x in text)))
    rows = [r for k, r in enumerate(rows) if r not in rows[:k]]
    want = brute(rows, 20)
    assert sum(map(bool, want.values())) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, tuple(zip(r.starts, r.ends, strict=True))) for r in linededup.remove(docs).collect())
    assert got == sorted((rows[k][0], tuple(x)) for k, x in want.items() if x)


def test_a_passage_inside_longer_lines_and_rewrapped(spark):
    passage = " ".join("The %s passage has words %d and so on until here." % (w, i) for i, w in enumerate("first second third fourth fifth sixth".split()))
    a, b, c = ("Start of %s without end and %s " % (x, x) for x in "abc")
    got = left(spark, a + passage + " tail a", b + passage + " tail b", c + passage.replace(" words", "\nwords") + " tail c.")
    assert got[0] == a + passage + " tail a"
    for text, tail in ((got[1], " tail b"), (got[2], " tail c.")):
        assert "third passage" not in text and "fourth passage" not in text and text.endswith(tail)


def test_long_texts_and_words_that_differ_everywhere(spark):
    one = [bin(i).count("1") % 2 for i in range(1024)]
    lines = [" ".join("az"[x] for x in one), " ".join("za"[x] for x in one)]
    assert left(spark, *lines) == dict(enumerate(lines))
    long = "x" * 300_000 + " " + " ".join("w%d" % i for i in range(60_000))
    got = left(spark, long, "begin\n" + long + "\nend")
    assert got[0] == long and got[1] == "begin\nend"


def test_repeated_rows_and_empty_tables(spark):
    text = "\n".join(" ".join("%s%d" % (c, i) for i in range(22)) for c in "ab")
    docs = spark.createDataFrame([(3, text), (3, text), (3, text), (None, text), (5, "x")], "doc_id long, text string")
    got = sorted((str(r.doc_id), len(r.starts)) for r in linededup.remove(docs).collect())
    assert got == [("3", 2), ("3", 2), ("None", 2)]
    assert linededup.report(docs.limit(0)).count() == 0


def numbered(letter, n, width, at=0):
    """n words, ``width`` a line."""
    words = ["%s%d" % (letter, i) for i in range(at, at + n)]
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, n, width))


def left(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = dict(enumerate(texts))
    return out | {r.doc_id: r.left for r in linededup.remove(docs).collect()}


def test_passages_of_short_lines(spark):
    """A passage set in lines under 20 words, of any width, is removed whole and only where it recurs."""
    for width in (1, 3, 7, 13, 19):
        passage = numbered("p", 60, width)
        texts = [f"{numbered('a', 5, 5)}\n{passage}\n{numbered('b', 5, 5)}", f"{numbered('c', 30, 6)}\n\n{passage}\n{numbered('d', 9, 3)}", passage]
        got = left(spark, *texts)
        assert got[0] == texts[0]
        assert got[1] == f"{numbered('c', 30, 6)}\n\n{numbered('d', 9, 3)}" and got[2] == ""
    apart = "\n\n".join(numbered("q", 40, 8).split("\n"))  # with blank lines between
    assert left(spark, apart, "x\n" + apart + "\ny")[1] == "x\ny"


def test_uneven_runs_to_their_last_line(spark):
    run = "\n".join([numbered("a", 15, 15), numbered("b", 15, 15), numbered("c", 3, 3)])
    assert left(spark, run + "\nend one", "start\n" + run + "\nend two")[1] == "start\nend two"


def test_rewrapped_paragraphs(spark):
    one, two, three = (numbered("p", 50, width) for width in (50, 12, 25))
    got = left(spark, f"x\n\n{one}\n\ny", f"z\n\n{two}\n\nw", three)
    assert got[0] == f"x\n\n{one}\n\ny" and got[1] == "z\n\n\nw" and got[2] == ""


def test_short_runs_and_first_copies_stay(spark):
    texts = ["Heading\nBy the same author", "Heading\nBy the same author\n" + numbered("a", 30, 30), numbered("r", 7, 7) + ("\n" + numbered("r", 7, 7)) * 6]
    got = left(spark, *texts)
    assert got[0] == texts[0] and got[1] == texts[1]
    assert got[2].split() == numbered("r", 7, 7).split() * 3  # the first 20 words and more stay once
