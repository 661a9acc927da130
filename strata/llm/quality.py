"""Quality rules with risk-controlled cutoffs.

Four scores (symbols, capitals, repeated lines, repeated words) say how much a
text looks like junk. A cutoff for each score and stratum is picked on the
labelled documents: of a fixed grid, the lowest for which the rate of good
documents above it is shown to be under ``RISK`` / 4. Shown means an exact
binomial test: with k of n good documents above the cutoff, the chance of k or
fewer at that rate is under ``ERROR`` divided by the number of tests made. So
with a probability of ``1 - ERROR``, no stratum loses more than ``RISK`` of its
good documents. Where the labels don't suffice, nothing is rejected.

The grid doesn't depend on the labels, so the tests hold. Everything here is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import staged, text_of

RISK, ERROR = 0.02, 0.05
#: Scores and their grids.
GRIDS = {
    "symbols": tuple(i / 100 for i in (1, 2, 3, 4, 5, 7, 10, 14, 19, 25, 35, 50, 70)),  # of characters in words
    "capitals": tuple(i / 100 for i in (8, 10, 12, 15, 20, 25, 30, 40, 50, 60, 75, 90)),  # of characters in words
    "lines": tuple(i / 100 for i in (5, 10, 15, 20, 25, 30, 35, 40, 50, 60, 75, 90)),  # of lines with a word
    "words": tuple(i / 100 for i in (3, 5, 8, 10, 12, 14, 16, 18, 20)),  # of words; above that the base rule fails
}
_WHITE = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
_WINDOW = 5


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns id, stratum and text give id, stratum, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals."""
    text = F.col(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    size = F.length(text)
    one = docs.select(
        "id", "stratum", words.alias("words"), lines.alias("lines"), _without(text, _WHITE).cast("long").alias("word_chars"),
        (size - _without(text, "#*$%&|<>")).cast("long").alias("n_symbols"), (size - _without(text, _CAPITALS)).cast("long").alias("n_capitals"),
    )
    last = F.size("words") - _WINDOW
    window = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(_WINDOW)]))
    two = one.select(
        "id", "stratum", "word_chars", "n_symbols", "n_capitals", F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(last >= 0, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # windows that occur twice, by sorting; only for texts that have any
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered).otherwise(nothing)).drop("windows")

    def twice(x: Column, i: Column) -> Column:
        same = lambda k: F.coalesce(F.get(F.col("ordered"), k)["h"] == x["h"], F.lit(False))
        return same(i - 1) | same(i + 1)

    places = F.sort_array(F.transform(F.filter("ordered", twice), lambda x: x["i"]))
    state = F.struct(F.lit(-_WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(places, state, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(_WINDOW), p - s["last"])).alias("n")), lambda s: s["n"])
    four = three.withColumn("n_repeat_words", F.when(F.size("ordered") == 0, F.lit(0).cast("long")).otherwise(covered)).drop("ordered")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return four.withColumn("base_failed", failed)


def _scores() -> dict[str, Column]:
    chars, lines, words = (F.greatest(F.col(c), F.lit(1)) for c in ("word_chars", "n_lines", "n_words"))
    return {"symbols": F.col("n_symbols") / chars, "capitals": F.col("n_capitals") / chars, "lines": F.col("n_dup_lines") / lines, "words": F.col("n_repeat_words") / words}


def log_at_most(k: Column, n: Column, rate: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, rate), exactly, for k below n * rate (else 0)."""
    odds = F.log(F.lit(rate / (1 - rate)))
    none = n * F.log(F.lit(1 - rate))
    start = F.struct(none.alias("term"), none.alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        total = F.greatest(s["sum"], term) + F.log1p(F.exp(-F.abs(s["sum"] - term)))
        return F.struct(term.alias("term"), total.alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.when(k < n * rate, F.aggregate(steps, start, step, lambda s: s["sum"])).otherwise(F.lit(0.0))


def cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, score, cutoff) shown to be safe on measured good documents; none without enough of them."""
    rate = risk / len(GRIDS)
    rows = [F.struct(F.lit(name).alias("score"), F.array(*map(F.lit, GRIDS[name])).alias("grid"), value.alias("value")) for name, value in _scores().items()]
    each = good.select("stratum", F.explode(F.array(*rows)).alias("x"))
    above = F.size(F.filter("x.grid", lambda c: F.col("x.value") > c))  # so many of the grid's cutoffs reject it
    counts = each.groupBy("stratum", "x.score", "x.grid").agg(F.count("*").alias("n"), *[F.sum((above > k).cast("long")).alias(f"k{k}") for k in range(max(map(len, GRIDS.values())))])
    tests = counts.select("stratum", "score", "n", F.posexplode("grid").alias("place", "cutoff"), F.array(*[f"k{k}" for k in range(max(map(len, GRIDS.values())))]).alias("ks"))
    tests = tests.select("stratum", "score", "n", "cutoff", F.get("ks", F.col("place")).alias("k"))
    made = tests.groupBy("stratum").agg(F.lit(1)).count() * sum(map(len, GRIDS.values()))
    shown = tests.where(log_at_most(F.col("k"), F.col("n"), rate) <= F.log(F.lit(error / max(1, made))))
    return shown.groupBy("stratum", "score").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Base rules and risk-controlled cutoffs on every document.

    ``labels``: ``doc_id``, ``quality`` (1 good, 0 not; a document with both
    counts as not). Returns one row per document: ``doc_id``, ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``. A null text has no words, and fails. A null
    stratum is one of its own; null labels, and labels of no document, don't
    count; repeated documents are judged alike (each is a labelled one if its id
    is). Further columns aren't read; an empty table gives no rows.
    """
    part = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), text_of(text_col).alias("text"))
    scored = staged(measured(part), "quality")
    good = labels.where("quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("q")).where("q = 1").select("id")
    safe = cutoffs(scored.where("NOT base_failed").join(good, "id", "left_semi"), risk, error)
    wide = safe.groupBy(F.col("stratum").alias("s")).pivot("score", list(GRIDS)).agg(F.min("cutoff"))
    wide = staged(wide, "cutoffs")
    over = F.lit(False)
    for name, value in _scores().items():
        over = over | F.coalesce(value > F.col(f"wide.{name}"), F.lit(False))
    out = scored.join(wide.alias("wide"), F.col("stratum").eqNullSafe(F.col("s")), "left")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
