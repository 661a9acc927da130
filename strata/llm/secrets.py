"""Secret scans: patterns, and character Markov models.

Two Markov models of order one run over the characters of a candidate string:
one of random strings (keys, digests), one of ordinary identifiers. Their
log-likelihood ratio per character tells a key from a name; stretches above the
cutoff are reported besides the pattern matches, wherever in a string they stand.

Both are counted from labelled samples by grouped aggregation: random strings
are the values that the patterns find, ordinary ones are words of letters. A
model is a table of one size (pairs of ``len(ALPHABET)`` characters), whatever
the input. Everything here is DataFrame operations.

Work is linear in a text and its matches: places are running sums in steps of
``STEP`` entries, and pieces of a text are taken from chunks of ``CHUNK`` characters,
since a substring is otherwise looked for from the text's beginning each time.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import fresh, staged, text_of

#: Pattern of each kind, the group that is measured, its least length: fixed values of the query's contract.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: What the models are asked about: runs of key characters that are long and hold a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Characters of a key at least, among names and paths glued to it.
LEAST = 20
SEPARATORS = "=/"
#: Ordinary words and identifiers that the other model learns from: too short to be a candidate.
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_-]{7,18}(?![A-Za-z0-9+/_=-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Log-likelihood ratio per character from which a candidate is reported.
CUTOFF = 0.7
#: Share of a model that is counted; the rest holds every character equally likely.
COUNTED_RANDOM, COUNTED_ORDINARY = 0.5, 0.9
BACKOFF = 5.0
#: Entries whose running sums are taken in one go, and characters of a chunk of text.
STEP, CHUNK = 256, 4096


def _named(value: Column, use) -> Column:
    """``use`` of a value that is used more than once: an array of one value names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(items: Column, zero: Column, step, shift) -> Column:
    """An array made by walking ``items`` with running state, in time linear in it.

    Blocks of ``STEP`` items are walked one by one: ``step(state, item)`` gives the state's
    new ``at`` and appends to its ``out``. ``shift(at, out)`` then makes the parts of
    a block right for what came before it; ``zero.at`` starts both walks.
    """

    def walked(items: Column) -> Column:
        last = F.greatest(F.size(items) - 1, F.lit(0))
        numbers = F.sequence(F.lit(0), F.floor(last / STEP).cast("int"))
        return F.transform(numbers, lambda b: F.aggregate(F.slice(items, b * STEP + 1, F.lit(STEP)), zero, step))

    def joined(each: Column) -> Column:
        first = F.struct(zero["at"].alias("at"), F.array().cast("array<int>").alias("out"))
        total = F.aggregate(each, first, lambda s, b: F.struct(shift(s["at"], b["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]
        return F.zip_with(each, total, lambda b, at: F.transform(b["out"], lambda x: shift(at, x)))

    return F.flatten(_named(_named(items, walked), joined))


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))


def _piece(chunks: Column, start: Column, size: Column) -> Column:
    """``size`` characters of a text from ``start`` (0 is the first) on; none if that is no positive number."""
    first = F.floor(start / CHUNK).cast("int")
    count = F.floor((start + size - 1) / CHUNK).cast("int") - first + 1
    found = F.substring(F.array_join(F.slice(chunks, first + 1, F.greatest(count, F.lit(1))), ""), start - first * CHUNK + 1, size)
    return F.when(size > 0, found).otherwise(F.lit(""))


def _spans(text: Column, pattern: str, group: int, least: int, kind: str, rank: int, strings: bool = False) -> Column:
    """Array of (start, end, rank, kind) of a pattern's matches, in code points; with ``strings`` and what matches.

    The pieces between the matches come from a split, the matches from an
    extraction; running sums of their lengths are the places.
    """
    fields = "struct<start:int,end:int,rank:int,kind:string" + (",s:string>" if strings else ">")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part")), lambda x: x["whole"].isNotNull())
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        lo = state["at"] + F.length(x["gap"])
        return F.struct((lo + F.length(x["whole"])).alias("at"), F.concat(state["out"], F.array(lo)).alias("out"))

    def span(x: Column, lo: Column) -> Column:
        own = [lo.alias("start"), (lo + F.length(x["whole"])).alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")]
        return F.when(F.length(x["part"]) >= least, F.struct(*own, *([x["whole"].alias("s")] if strings else [])))

    placed = _named(rows, lambda r: F.zip_with(r, _running(r, zero, step, lambda at, x: at + x), span))
    found = F.filter(placed, lambda x: x.isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{fields}>"))


def base_spans(text: Column) -> Column:
    """All pattern matches of a text by start, then by the order of ``KINDS``."""
    each = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        if kind == "hex":  # shorter runs fail anyway, and runs don't overlap
            pattern = r"[0-9a-f]{%d,}" % least
        each.append(_spans(text, pattern, group, least, kind, rank))
    return F.array_sort(F.concat(*each))


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring characters, by label: (label, a, b, n). A string begins after character 0."""
    place = F.transform(F.split("s", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    some = strings.select("label", F.filter(place, lambda p: p > 0).alias("p")).where("size(p) > 1")
    both = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("p")).alias("a"), F.col("p").alias("b"))
    return some.select("label", F.explode(F.filter(both, lambda x: x["b"].isNotNull())).alias("x")).groupBy("label", "x.a", "x.b").agg(F.count("*").alias("n"))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of every pair of characters, from (label, s): label 1 is random.

    Pairs are backed off to single characters (which count for ``BACKOFF``
    pairs), and mixed with the uniform distribution, since keys may use
    characters that no labelled one has.
    """
    width = len(ALPHABET) + 1
    counts = {1: [[0] * width for _ in range(width)], 0: [[0] * width for _ in range(width)]}
    for r in _pairs(labelled).collect():  # at most 2 * width * width rows
        counts[r.label][r.a][r.b] += r.n
    single = {x: [sum(column) for column in zip(*rows, strict=True)] for x, rows in counts.items()}

    def log(label: int, a: int, b: int, share: float) -> float:
        row, every = counts[label][a], max(1, sum(single[label]))
        return math.log(share * (row[b] + BACKOFF * single[label][b] / every) / (sum(row) + BACKOFF) + (1 - share) / width)

    return [log(1, a, b, COUNTED_RANDOM) - log(0, a, b, COUNTED_ORDINARY) for a in range(width) for b in range(width)]


def _longer(least: int):
    return lambda v: F.length(v) >= least


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def samples(docs: DataFrame, text: Column) -> DataFrame:
    """Labelled strings (label, s), each once: values that the patterns find in any text, and the words of all texts."""
    found = []
    for kind, pattern, group, least in KINDS:
        pattern = r"[0-9a-f]{%d,}" % least if kind == "hex" else pattern
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        found.append(F.when(text.rlike(pattern), F.filter(values, _longer(least))).otherwise(F.array().cast("array<string>")))
    secret = docs.select(F.lit(1).alias("label"), F.explode(F.concat(*found)).alias("s"))
    words = docs.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0))).alias("s"))
    return secret.union(words).distinct()


def scores(table: list[float]) -> list[float]:
    """A table of ``train`` for :func:`stretch`: separators count 0, since no ordinary word holds one, and a word begins after each."""
    width = len(ALPHABET) + 1
    marks = [ALPHABET.index(c) + 1 for c in SEPARATORS]
    return [0.0 if b in marks else table[(0 if a in marks else a) * width + b] for a in range(width) for b in range(width)]


def stretch(string: Column, ratios: Column, cutoff: float) -> Column:
    """(start, end) of what is a key in a string of key characters, or null.

    There is one if in any ``LEAST`` characters or more the log-likelihood ratio
    (``ratios``: the array of :func:`scores`) is ``cutoff`` a character; a running maximum over the
    stretches that end at each character finds it. It begins where the sum of the
    ratios, less half the cutoff each, is lowest and ends where it is highest, after the last such stretch if
    there are more, both widened to the next of ``SEPARATORS`` or the string's end.
    """
    width = len(ALPHABET) + 1
    never, drop = F.lit(-1e300), LEAST * cutoff

    def of(places: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), places), 1, F.size(places))
        return F.zip_with(before, places, lambda a, b: F.get(ratios, a * width + b))

    def late(x: Column) -> Column:
        gone = F.slice(F.concat(F.array_repeat(F.lit(0.0), LEAST), x), 1, F.size(x))
        return F.zip_with(x, gone, lambda new, old: F.struct(new.alias("new"), old.alias("old")))

    def step(s: Column, x: Column) -> Column:
        at, total, last = s["at"] + 1, s["total"] + x["new"] - cutoff / 2, s["last"] + x["new"] - x["old"]
        best = F.when(at >= LEAST, F.greatest(s["best"] + x["new"] - cutoff, last - drop)).otherwise(never)
        shut = s["start"].isNotNull() & (total < s["high"] - drop / 2)  # the key is over, another may follow
        best = F.when(shut, F.when(at >= LEAST, last - drop).otherwise(never)).otherwise(best)
        hit = best >= -1e-9
        up = F.when(s["start"].isNull() | shut | s["shut"], hit).otherwise(total > s["high"])
        return F.struct(
            at.alias("at"), total.alias("total"), last.alias("last"), best.alias("best"),
            F.least(s["low"], total).alias("low"), F.when(total <= s["low"], at).otherwise(s["low_at"]).alias("low_at"),
            F.when(s["start"].isNull() & hit, s["low_at"]).otherwise(s["start"]).alias("start"),
            F.when(up, at).otherwise(s["end"]).alias("end"), F.when(up, total).otherwise(s["high"]).alias("high"),
            ((shut | s["shut"]) & ~hit).alias("shut"),
        )

    nowhere = F.lit(None).cast("int")
    first = F.struct(
        F.lit(0).alias("at"), F.lit(0.0).alias("total"), F.lit(0.0).alias("last"), never.alias("best"), F.lit(0.0).alias("low"), F.lit(0).alias("low_at"),
        nowhere.alias("start"), nowhere.alias("end"), never.alias("high"), F.lit(False).alias("shut"),
    )

    def widened(s: Column) -> Column:
        head = F.regexp_extract(F.substring(string, F.lit(1), s["start"]), f"[^{SEPARATORS}]*$", 0)
        tail = F.regexp_extract(F.substring(string, s["end"] + 1, F.length(string)), f"^[^{SEPARATORS}]*=*", 0)
        return F.when(s["start"].isNotNull(), F.struct((s["start"] - F.length(head)).alias("start"), (s["end"] + F.length(tail)).alias("end")))

    places = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return _named(places, lambda p: _named(of(p), lambda x: _named(F.aggregate(late(x), first, step), widened)))


def _ends_before(spans: Column) -> Column:
    """For each of sorted spans the greatest end of those before it, 0 for the first."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    return _running(spans, zero, step, F.greatest)


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with ``by(span, end)`` in place of its sorted spans; ``end``: where the spans before it end."""

    def pieces(chunks: Column) -> Column:
        parts = F.zip_with(spans, _ends_before(spans), lambda x, end: F.concat(_piece(chunks, end, x["start"] - end), by(x, end)))
        last = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(parts, ""), _piece(chunks, last, F.length(text) - last))

    return F.when(F.size(spans) == 0, text).otherwise(_named(_chunks(text), pieces))


def _blank(x: Column, end: Column) -> Column:
    return F.repeat(F.lit(" "), F.greatest(x["end"] - F.greatest(x["start"], end), F.lit(0)))


def _fixed(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed where they stand.

    The optimizer puts an expression in place of every reference to its column, also
    in filters that come later, so that expressions built on each other grow without
    bound; a count of rows on the way keeps it from doing so.
    """
    return df.observe(f"fixed-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"))


def _scanned(docs: DataFrame, text: Column, names: tuple[str, str, str, str], cutoff: float) -> DataFrame:
    """``docs`` with columns ``names``: the text, pattern matches, further candidates, all spans."""
    name, base, more, found = names
    part = _fixed(docs.withColumn(name, text))
    model = docs.sparkSession.createDataFrame([(scores(train(samples(part, F.col(name)))),)], "ratios array<double>")
    digit_and_letter = r"(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])"
    pattern = rf"(?<![A-Za-z0-9+/_=-]){digit_and_letter}{CANDIDATE}"
    ratios = fresh(part, "ratios")
    part = part.withColumn(ratios, staged(model, "key-model").scalar())  # one row, read once by the plan
    part = _fixed(part.withColumn(base, base_spans(F.col(name))))
    rest = fresh(part, "rest_of_text")
    part = _fixed(part.withColumn(rest, _replaced(F.col(name), F.col(base), _blank)))
    part = _fixed(part.withColumn(more, _spans(F.col(rest), pattern, 0, 1, "markov", len(KINDS), strings=True)).drop(rest))

    def key(m: Column) -> Column:
        def moved(x: Column) -> Column:
            return F.when(x.isNotNull(), F.struct((m["start"] + x["start"]).alias("start"), (m["start"] + x["end"]).alias("end"), m["rank"].alias("rank"), m["kind"].alias("kind")))

        return _named(stretch(m["s"], F.col(ratios), cutoff), moved)

    joined = F.array_sort(F.concat(F.col(base), F.filter(F.transform(more, key), lambda x: x.isNotNull())))
    return _fixed(part.withColumn(found, F.when(F.size(more) == 0, F.col(base)).otherwise(joined)).drop(ratios))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """Secrets in every text, in code points, ends exclusive.

    Returns one row per input row: ``id_col``, ``base`` (pattern matches) and
    ``found`` (those, and ``markov`` spans that overlap none of them): arrays of
    (start, end, rank, kind), sorted. A null text counts as empty and has none.
    Rows are independent: null and repeated ids pass through, further columns
    aren't read, an empty table gives no rows.
    """
    part = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("own"))
    found = _scanned(part, F.col("own"), ("text", "base", "more", "found"), cutoff)
    return found.select(F.col("id").alias(id_col), "base", "found")


def listed(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, a digest of the pattern matches, and all spans."""
    found = scan(docs, id_col, text_col)
    counts = [F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind, *_ in KINDS]
    return found.select(id_col, *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("found").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text", size_col: str = "n_chars", cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; ``size_col``, if there, follows.

    Spans that overlap are one. Texts without secrets, null too, and all other
    columns stay as they are.
    """
    names = tuple(fresh(docs, n) for n in ("own_text", "base_spans", "more_spans", "all_spans"))
    own, spans = F.col(names[0]), F.col(names[3])
    clean = _replaced(own, spans, lambda x, end: F.when(x["start"] >= end, F.lit(mark)).otherwise(F.lit("")))
    hit = F.size(spans) > 0
    text = fresh(docs, "clean_text")
    part = _scanned(docs, text_of(text_col), names, cutoff).withColumn(text, F.when(hit, clean).otherwise(F.col(text_col)))
    new = {text_col: F.col(text)}
    if size_col in docs.columns:
        new[size_col] = F.when(hit, F.length(text).cast(docs.schema[size_col].dataType)).otherwise(F.col(size_col))
    return part.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
