"""Aggregate building blocks.

The non-algebraic aggregates (most frequent value, distinct string list) are
computed in two levels: first a partial-aggregated ``groupBy`` on
(group keys + value), then a second aggregate over those small rows. A hot
group therefore never holds its raw rows in one task; only its distinct values
(the result itself) meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import ColumnOrName, _col


def count_if(predicate: Column) -> Column:
    """``COUNT_IF(p)``: rows where p is true; NULL counts as false."""
    return F.count_if(predicate)


def nonnull_value(c: ColumnOrName) -> Column:
    """``ANY_VALUE`` that prefers a non-NULL value, made repeatable.

    Equal to any non-NULL row value when the column is constant within the
    group (the case the marts rely on); ``max`` makes the pick deterministic.
    """
    return F.max(_col(c))


def mode_from_counts(value: ColumnOrName, count: ColumnOrName) -> Column:
    """Most frequent value given (value, count) rows of one group.

    NULL values are ignored, ties go to the smallest value, all-NULL gives
    NULL. ``min_by`` is an ordinary partial aggregate, so this stays skew-safe.
    """
    v = _col(value)
    n = _col(count)
    rank = F.when(v.isNotNull(), F.struct((-n).alias("neg_count"), v.alias("value")))
    return F.min_by(F.when(v.isNotNull(), v), rank)


def mode(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """``MODE(value)`` per group of ``keys`` in the two-level form."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(mode_from_counts(value, "_n").alias(alias or value))


def sorted_list_agg(value: str, sep: str = ", ", distinct: bool = False) -> Column:
    """``STRING_AGG(value, sep)`` ordered by value; NULLs skipped, all-NULL → NULL.

    Feed it already-distinct values (see :func:`string_agg_distinct`) so each
    group's buffer holds only the distinct set.
    """
    quoted = f"`{value}`"
    lit_sep = sep.replace("'", "\\'")
    keyword = "DISTINCT " if distinct else ""
    return F.expr(f"listagg({keyword}{quoted}, '{lit_sep}') WITHIN GROUP (ORDER BY {quoted})")


def string_agg_distinct(
    df: DataFrame, keys: Sequence[str], value: str, sep: str = ", ", alias: str | None = None
) -> DataFrame:
    """``STRING_AGG(DISTINCT value, sep)`` per group, values sorted ascending."""
    distinct_values = df.select(*keys, value).distinct()
    return distinct_values.groupBy(*keys).agg(sorted_list_agg(value, sep).alias(alias or value))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """Row count of a table as a one-row frame (``.height``)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def rows_per_group(df: DataFrame, keys: Sequence[str], alias: str = "row_count") -> DataFrame:
    """Row count per group (``group_by(k).len()``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column, in one pass (``null_count()``)."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def exact_distinct(df: DataFrame, keys: Sequence[str], id_col: str, alias: str) -> DataFrame:
    """Exact number of distinct ids per group by bitmaps, one in memory at a time.

    ``id_col`` holds integers from 0 on (negative ones too), NULLs aren't counted. A bitmap covers 32,768 ids
    in 4 kB, however few of them a group has. So none is shuffled or sorted: repeated ids are
    dropped map-side, the others are dealt to tasks by (group, range of ids) as narrow rows, and each
    range's bitmap is built and counted there.
    """
    some = df.where(F.col(id_col).isNotNull())
    held = some.select(
        *keys, F.bitmap_bucket_number(F.col(id_col)).alias("_range"), F.bitmap_bit_position(F.col(id_col)).alias("_bit")
    )
    dealt = held.distinct().repartition(*keys, "_range")
    ranges = dealt.groupBy(*keys, "_range").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    return ranges.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(alias))
