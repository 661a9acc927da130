"""Aggregates over all slices from states that are kept by slice.

A slice's state has a row for each (entity, value): how many rows, and sums, counts
and bounds that can be added up. States of different slices are merged by sums, minima
and maxima; rows by value are a histogram, from which MODE and STRING_AGG DISTINCT
follow. So a reload of some keys recomputes the states of those keys only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.aggs import mode_from_counts, sorted_list_agg
from strata.sources.versioned import SliceTable


def slice_states(rows: DataFrame, slice_column: str, entity: str, value: str, total: str, measure: str, moment: str) -> DataFrame:
    """States by (slice, entity, value): rows, sum of ``total``, sum and count of ``measure``, bounds of ``moment``."""
    return rows.groupBy(F.col(slice_column).cast("string").alias(slice_column), entity, value).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(total).alias("total"),
        F.count(total).alias("total_n"),
        F.sum(F.col(measure).cast("double")).alias("measure"),
        F.count(measure).alias("measure_n"),
        F.min(moment).alias("first"),
        F.max(moment).alias("last"),
    )


def merged(states: DataFrame, entity: str, value: str) -> DataFrame:
    """One row per entity over all slices: the aggregates that its rows would give at once.

    ``total`` and ``measure_avg`` are NULL if no row has the value, ``most_frequent``
    goes to the smallest of those that tie, ``all_values`` is sorted; NULL values
    are ignored in both.
    """
    by_value = states.groupBy(entity, value).agg(
        *[F.sum(c).alias(c) for c in ("rows", "total", "total_n", "measure", "measure_n")], F.min("first").alias("first"), F.max("last").alias("last")
    )
    n = F.sum("measure_n")
    return by_value.groupBy(entity).agg(
        F.sum("rows").alias("rows"),
        F.when(F.sum("total_n") > 0, F.sum("total")).alias("total"),
        F.try_divide(F.sum("measure"), n).alias("measure_avg"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        mode_from_counts(value, "rows").alias("most_frequent"),
        sorted_list_agg(value).alias("all_values"),
    )


def reload(table: SliceTable, states: DataFrame, keys: Sequence[str]) -> int:
    """Replace the states of the slices ``keys``; all others stay as they are."""
    wanted = [str(k) for k in keys]
    return table.load(states.where(F.col(table.slice_column).isin(wanted)), wanted, "RELOAD")
