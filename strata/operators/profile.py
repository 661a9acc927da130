"""Table profile: schema, row count, NULL counts, and a repeatable sample."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.aggs import null_counts, row_count


@dataclass
class Profile:
    schema: T.StructType
    rows: DataFrame
    nulls: DataFrame
    columns: DataFrame
    sample: DataFrame


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: ``position, column_name, data_type, row_count, null_count``, from one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    each = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("rows").alias("row_count"), F.col(f"n{i}").alias("null_count"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def row_digest(columns: Sequence[str]) -> F.Column:
    """MD5 of a row's values as text; NULL and the empty text differ."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x01")) for c in columns]))


def bottom_k_sample(df: DataFrame, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` rows with the smallest digests: the same rows however the table is split or stored.

    Each task keeps its own k smallest before the final merge. ``columns`` (default: all
    that have a text form) are those in the digest; repeated rows tie.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    digest = row_digest(list(columns) if columns is not None else plain)
    return df.withColumn("row_digest", digest).orderBy("row_digest").limit(k)


def profile(df: DataFrame, sample_rows: int = 5) -> Profile:
    """Lazy frames for each part; the caller decides what to run."""
    return Profile(df.schema, row_count(df), null_counts(df), column_profile(df), bottom_k_sample(df, sample_rows).drop("row_digest"))
