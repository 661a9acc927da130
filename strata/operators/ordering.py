"""Sorts and top-k with explicit NULL placement and tie keys.

The original engine sorts NULLs last for both directions, Spark sorts them
first for ascending; every helper here states the placement. Ties are broken
by the given tie keys so a top-k is repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def order(df: DataFrame, keys: Sequence[Column], ties: Sequence[str] = ()) -> DataFrame:
    """Global sort by ``keys`` then ascending ``ties`` (range-partitioned sort)."""
    return df.orderBy(*keys, *[asc(t) for t in ties])


def top_k(df: DataFrame, k: int, keys: Sequence[Column], ties: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``keys``: planned as TakeOrderedAndProject, so each
    partition keeps only its own k best rows before the final merge."""
    return order(df, keys, ties).limit(k)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """``head()``: the first n rows, no order promised."""
    return df.limit(n)
