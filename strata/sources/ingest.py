"""Bronze loads: reader → optional shape → key stamp → slice replacement.

One load of several keys (a backfill) is one read, one write job and one
commit with a row per key. A source with an inventory is loaded only if every
key has a complete landing (each page once, none damaged, all up to the reported
total); otherwise the load fails before anything is written, and the old slices
stay live. A key whose landed total is 0 becomes an empty slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.shaping import apply_shape
from strata.paths import bronze_location
from strata.sources.pages import PAGE_OFFSET, landing_problems
from strata.sources.versioned import SliceTable
from strata.specs import KEY_COLUMN, Dataset, SourceSpec


def bronze_table(spark: SparkSession, dataset: Dataset, spec: SourceSpec, root: str | None) -> SliceTable:
    slice_col = spec.partition_column if dataset.partitioned else None
    return SliceTable(spark, bronze_location(dataset.name, spec.name, root), slice_col, shredded=spec.shredded)


def bronze_frame(spark: SparkSession, dataset: Dataset, spec: SourceSpec, keys: Sequence[str] | None) -> DataFrame:
    """Records of one source for ``keys``, shaped and stamped, ready to write."""
    partitioned = dataset.partitioned and spec.partition_column is not None
    records = spec.reader(spark, list(keys) if partitioned and keys is not None else None)
    shaped = apply_shape(records, spec.shape)
    if partitioned:
        shaped = shaped.withColumn(spec.partition_column, F.col(KEY_COLUMN).cast("string"))
    return shaped.drop(KEY_COLUMN, PAGE_OFFSET)


class IncompleteLanding(RuntimeError):
    """A key's landed pages aren't complete; nothing was loaded."""


def check_landing(spark: SparkSession, spec: SourceSpec, keys: Sequence[str] | None) -> None:
    """Raise ``IncompleteLanding`` unless every key has a complete landing."""
    if spec.inventory is None:
        return
    # a few numbers of each page, kept: the pages are parsed once, however often they are looked at
    pages = spec.inventory(spark, list(keys) if keys is not None else None).persist()
    try:
        problems = landing_problems(pages, spec.page_size)
        if keys is not None:
            wanted = spark.createDataFrame([(str(k),) for k in keys], "key string")
            absent = wanted.join(pages.select("key").distinct(), "key", "left_anti")
            nothing = absent.select("key", F.lit(None).cast("long").alias("offset"), F.lit("no page landed").alias("reason"))
            problems = problems.unionByName(nothing)
        found = problems.orderBy("key", "offset", "reason").limit(20).collect()
    finally:
        pages.unpersist()
    if found:
        listed = "; ".join(f"{r.key} offset {r.offset}: {r.reason}" for r in found)
        raise IncompleteLanding(f"{spec.name}: {listed}")


def load_source(
    spark: SparkSession,
    dataset: Dataset,
    spec: SourceSpec,
    keys: Sequence[str] | None = None,
    root: str | None = None,
) -> int:
    """Load one source for ``keys`` (default: all of the dataset's keys)."""
    table = bronze_table(spark, dataset, spec, root)
    partitioned = dataset.partitioned and spec.partition_column is not None
    if partitioned:
        wanted = list(keys) if keys is not None else list(dataset.partitions or ())
        check_landing(spark, spec, wanted)
        return table.load(bronze_frame(spark, dataset, spec, wanted), wanted, rebalanced=spec.rebalanced)
    check_landing(spark, spec, None)
    return table.load(bronze_frame(spark, dataset, spec, None))


def load_bronze(
    spark: SparkSession, dataset: Dataset, keys: Sequence[str] | None = None, root: str | None = None
) -> dict[str, int]:
    """Load every source of the dataset; returns the new version per table."""
    return {spec.name: load_source(spark, dataset, spec, keys, root) for spec in dataset.sources}


def read_bronze(
    spark: SparkSession, dataset: Dataset, root: str | None = None, version: int | None = None
) -> dict[str, DataFrame]:
    """Current (or as-of) frame of every bronze table, with declared schemas."""
    out = {}
    for spec in dataset.sources:
        table = bronze_table(spark, dataset, spec, root)
        out[spec.name] = table.read(version=version, schema=dataset.raw_schemas.get(spec.name))
    return out
