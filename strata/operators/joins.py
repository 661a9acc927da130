"""Join forms used by the marts and ad-hoc queries.

No join here carries a broadcast hint: with AQE on, Spark measures each side
after its shuffle stage and converts a sort-merge join to a broadcast join only
when the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
That runtime check is the size bound; beyond it the sort-merge join runs, and
AQE's skew handling splits oversized partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import zero_if_null
from strata.operators.aggs import nonnull_value

MATCH_COUNT = "_match_count"


def left_join_zero_fill(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fill: Sequence[str]
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` with ``COALESCE(x, 0)`` on ``fill``.

    Keys only present on the right are dropped; NULL keys never match.
    """
    joined = left.join(right, list(keys), "left")
    for name in fill:
        joined = joined.withColumn(name, zero_if_null(name))
    return joined


def inner_join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left JOIN right USING (keys)``: rows without a partner drop out."""
    return left.join(right, list(keys), "inner")


def dimension_per_key(
    dims: DataFrame, keys: Sequence[str], attributes: Mapping[str, str]
) -> DataFrame:
    """One row per key of a dimension: attribute values and the match count.

    ``attributes`` maps output name -> dimension column. The match count is
    how many dimension rows share the key, i.e. how many times a row-level
    LEFT JOIN would repeat each fact row.
    """
    aggs = [F.count(F.lit(1)).alias(MATCH_COUNT)]
    aggs += [nonnull_value(src).alias(out) for out, src in attributes.items()]
    return dims.groupBy(*keys).agg(*aggs)


def attach_after_aggregate(
    stats: DataFrame,
    dims: DataFrame,
    keys: Sequence[str],
    attributes: Mapping[str, str],
    additive: Sequence[str],
) -> DataFrame:
    """Row-level ``facts LEFT JOIN dims ON keys`` then ``GROUP BY keys``, computed
    as aggregate-then-join.

    ``stats`` must already be grouped by exactly ``keys``. Each fact row of a
    group would be repeated once per matching dimension row (once if none), so
    additive measures (sums, counts) are multiplied by that match count, while
    averages and most-frequent values do not change. The result equals the
    row-level join for duplicate dimension rows too, and the join runs on one
    row per key instead of one per fact, so a hot key cannot skew it.
    """
    per_key = dimension_per_key(dims, keys, attributes)
    joined = stats.join(per_key, list(keys), "left")
    factor = F.coalesce(F.col(MATCH_COUNT), F.lit(1))
    for name in additive:
        joined = joined.withColumn(name, F.col(name) * factor.cast(joined.schema[name].dataType))
    return joined.drop(MATCH_COUNT)
