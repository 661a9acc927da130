"""Casts of text against the SQL engine's own, value by value."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.functions import scalars

TEXTS = [
    None, "", " ", "5", " 5 ", "+5", "-5", "5.", ".5", "-.5", "1.5", "-1.5", "2.5", "1e3", "1.5e1", "1E-3", "1e400", "5D", "1f", "1L", "0x10", "0X1f", "-0x10", "0b101", "0x", "1_000", "1__0", "_1", "1_", "1_000.5", "--5", "+",
    ".", "e3", "2147483647", "2147483648", "2147483647.4", "2147483647.5", "9007199254740993.4", "9223372036854775807", "9223372036854775808", "99999999999999999999999999", "inf", "-Infinity", "nan", "0x7fffffffffffffff", "0000012",
    "2024", "2024-03", "2024-03-05", "2024-3-5", "2024/03/05", "2024-02-30", "2024-13-01", "2024-03-05 10:11:12", "20240305", "abc",
]


def engine(kind):
    con = duckdb.connect()
    return [con.execute(f"SELECT TRY_CAST(? AS {kind})", [t]).fetchall()[0][0] for t in TEXTS]


@pytest.mark.parametrize("kind,cast", [("INTEGER", scalars.lenient_int), ("BIGINT", scalars.lenient_bigint), ("DOUBLE", scalars.lenient_double), ("DATE", scalars.lenient_date)])
def test_lenient_casts(spark, kind, cast):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", cast("t").alias("x"))
    got = [r.x for r in df.orderBy("i").collect()]
    for text, mine, theirs in zip(TEXTS, got, engine(kind), strict=True):
        if isinstance(theirs, datetime.date) and theirs.year in (1, 9999):
            theirs = None  # infinities aren't dates here
        assert mine == theirs or (isinstance(mine, float) and math.isnan(mine) and math.isnan(theirs)), (kind, text, mine, theirs)


@pytest.mark.parametrize("cast,good,bad", [(scalars.strict_int, "1.5", "5D"), (scalars.strict_double, "1_000.5", "1f"), (scalars.strict_date, "2024-03-05", "2024-03")])
def test_strict_casts_fail(spark, cast, good, bad):
    df = spark.createDataFrame([(good,), (None,)], "t string").select(cast("t").alias("x"))
    assert df.filter(F.col("x").isNotNull()).count() == 1
    with pytest.raises(Exception, match="not a"):
        spark.createDataFrame([(bad,)], "t string").select(cast("t").alias("x")).collect()


def test_a_strict_value_is_read_once_and_rare_forms_apart(spark):
    """Plans of casts stay small: one of ten columns was compiled to more than the JVM compiles, and ran interpreted."""
    df = spark.createDataFrame([("1",)], "t string").select(scalars.strict_int("t").alias("x"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("raise_error") == 1 and plan.count("RLIKE") <= 6, plan


@pytest.mark.parametrize("text", ["0", "-0", "+7", "007", "123456789", "2147483647", "2147483648", "-2147483649", "999999999999999999", "9223372036854775808",
                                  " 12\t", "12\n", "\x0012", "12\x7f", "1_0", "1__0", "1.5", "-2.5", ".5", "5.", "1e3", "0x1F", "0b101", "5D", "1f", "", " ", "x", "R",
                                  "inf", "-Infinity", "nan", "١٢", "1 2", "--1", None])
def test_texts_are_read_as_by_the_general_rule(spark, text):
    """Plain numbers take a short way; it gives what the rule for all texts gives."""
    bare = scalars._bare("t")
    number, stripped = bare.rlike(scalars._NUMBER), F.regexp_replace(bare, "_", "")

    def whole(kind):
        digits = F.when(number, stripped)
        hexed = F.when(bare.rlike(scalars._HEX), F.conv(F.regexp_extract(bare, scalars._HEX, 1), 16, 10))
        other = F.when(bare.rlike(scalars._HEX), hexed).when(bare.rlike(scalars._BITS), F.conv(F.regexp_extract(bare, scalars._BITS, 1), 2, 10))
        return F.coalesce(digits.try_cast(kind), F.round(digits.try_cast("decimal(38,18)")).try_cast(kind), other.try_cast(kind))

    real = F.when(number | bare.rlike(scalars._WORDS), stripped).try_cast("double")
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        F.struct(scalars.lenient_int("t"), scalars.lenient_bigint("t"), scalars.lenient_double("t").cast("string")).alias("got"),
        F.struct(whole("int"), whole("bigint"), real.cast("string")).alias("want"),
    ).first()
    assert tuple(row.got) == tuple(row.want)
