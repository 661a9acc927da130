"""Exact distinct counts by bitmaps: none of the 4 kB bitmaps is shuffled or sorted, however sparse the ids are."""

import contextlib
import io
import random

from strata.operators.aggs import exact_distinct


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def frame(spark, n):
    rnd = random.Random(n)
    wide = [0, 1, 5, 32766, 32767, 32768, 32769, 70000, -1, -7, -32768, -32769, 10**12, None]
    rows = [(rnd.choice([None, "a", "b"]), rnd.randrange(3), rnd.choice(wide) if rnd.random() < 0.5 else rnd.randrange(200)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, h int, id long")


def test_counts_equal_sets_of_ids(spark):
    rows, df = frame(spark, 3000)
    want = {}
    for g, h, i in rows:
        if i is not None:
            want.setdefault((g, h), set()).add(i)
    got = {(r.g, r.h): r.n for r in exact_distinct(df, ["g", "h"], "id", "n").collect()}
    assert got == {k: len(v) for k, v in want.items()}


def test_no_bitmap_meets_a_shuffle_or_a_sort(spark):
    text = plan_text(exact_distinct(frame(spark, 10)[1], ["g", "h"], "id", "n"))
    last, first = text.index("bitmap_construct_agg"), text.index("partial_bitmap_construct_agg")
    assert last < first and "Exchange" not in text[last:first] and "Sort [" not in text[last:first]
