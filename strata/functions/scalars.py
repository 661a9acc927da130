"""Scalar column helpers (casts, null handling, keys, struct access).

All helpers return built-in Column expressions; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------- casts
# Text is read as the original SQL engine reads it: numbers with an optional
# sign, fraction and exponent, digits grouped by single underscores, blanks
# around them; integers also as 0x and 0b text; fractions rounded half away from
# zero. Type suffixes (``5D``, ``1f``) and incomplete dates (``2024-03``) aren't
# values. Lenient casts give NULL for other text, strict ones fail the query.

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?\d+)?$"
_WORDS = r"(?i)^[+-]?(?:inf|infinity|nan)$"
_HEX, _BITS = r"^0[xX]0*([0-7][0-9a-fA-F]{15}|[0-9a-fA-F]{1,15})$", r"^0[bB]0*([01]{1,63})$"
_DATE = r"^\s*(\d{4})([-/])(\d{1,2})\2(\d{1,2})(?:[ T].*)?\s*$"


def _bare(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c).cast("string"), r"^[ \t\n\r\x0b\f]+|[ \t\n\r\x0b\f]+$", "")


def _or_fail(source: ColumnOrName, value: Column, kind: str) -> Column:
    text = _col(source).cast("string")
    message = F.concat(F.lit(f"not a {kind}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message)))


# Plain numbers are most of the texts: they are cast as they stand. Other forms are read
# inside a lambda, where a text is stripped once, and only if it could be a number.
_PLAIN = {"int": r"^[+-]?\d{1,9}$", "bigint": r"^[+-]?\d{1,18}$", "double": r"^[+-]?\d{1,15}(?:\.\d{1,15})?$"}


def _plain_or(c: ColumnOrName, kind: str, maybe: str, other: Callable[[Column], Column]) -> Column:
    text = _col(c).cast("string")
    read = F.transform(F.transform(F.array(text), _bare), other).getItem(0)
    return F.when(text.rlike(_PLAIN[kind]), text.try_cast(kind)).when(text.rlike(maybe), read)


def lenient_int(c: ColumnOrName, integral: str = "int") -> Column:
    """Text to integer, NULL when the text is not a number or overflows."""

    def other(text: Column) -> Column:
        digits = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", ""))
        whole = digits.try_cast(integral)
        rounded = F.round(digits.try_cast("decimal(38,18)")).try_cast(integral)
        based = F.when(text.rlike(_HEX), F.conv(F.regexp_extract(text, _HEX, 1), 16, 10)).when(
            text.rlike(_BITS), F.conv(F.regexp_extract(text, _BITS, 1), 2, 10)
        )
        return F.coalesce(whole, rounded, based.try_cast(integral))

    return _plain_or(c, integral, "[0-9]", other)


def lenient_bigint(c: ColumnOrName) -> Column:
    return lenient_int(c, "bigint")


def lenient_double(c: ColumnOrName) -> Column:
    """Text to double, NULL when the text is not a number."""

    def other(text: Column) -> Column:
        return F.when(text.rlike(_NUMBER) | text.rlike(_WORDS), F.regexp_replace(text, "_", "")).try_cast("double")

    return _plain_or(c, "double", "[0-9nN]", other)


def lenient_date(c: ColumnOrName) -> Column:
    """Text with year, month and day to date (a time after it is left out), else NULL."""
    text = _col(c).cast("string")
    parts = [F.regexp_extract(text, _DATE, k) for k in (1, 3, 4)]
    return F.when(text.rlike(_DATE), F.concat_ws("-", *parts)).try_cast("date")


def strict_int(c: ColumnOrName) -> Column:
    return _or_fail(c, lenient_int(c), "integer")


def strict_double(c: ColumnOrName) -> Column:
    return _or_fail(c, lenient_double(c), "number")


def strict_date(c: ColumnOrName) -> Column:
    return _or_fail(c, lenient_date(c), "date")


def nullif_empty(c: ColumnOrName) -> Column:
    return F.nullif(_col(c), F.lit(""))


# ---------------------------------------------------------------- composition


def concat_strict(*parts: ColumnOrName) -> Column:
    """``a || b || ...``: NULL as soon as one part is NULL; non-strings are cast."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def surrogate_key(season: ColumnOrName, entity: ColumnOrName, sep: str = "-") -> Column:
    """``season || '-' || entity``; NULL if either side is NULL."""
    return concat_strict(season, F.lit(sep), entity)


def zero_if_null(c: ColumnOrName) -> Column:
    """``COALESCE(x, 0)`` for a double measure."""
    return F.coalesce(_col(c), F.lit(0.0))


def field_path(*path: str) -> Column:
    """Column for a dotted path whose parts may contain dots or odd casing."""
    return F.col(".".join(f"`{p}`" for p in path))


def in_year(df: DataFrame, column: str, year: int) -> Column:
    """Whether a date or timestamp column lies in a year, as a half-open range that scans can push down."""
    kind = df.schema[column].dataType
    first, after = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz").cast(kind) for y in (year, year + 1))
    return (F.col(column) >= first) & (F.col(column) < after)


def type_text(t: T.DataType) -> str:
    """A type as DDL text with every field name quoted, whatever characters it has."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{type_text(f.dataType)}" for f in t.fields) + ">"
    return f"array<{type_text(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()
