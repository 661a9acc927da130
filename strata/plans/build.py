"""Model builds: bronze → silver → gold, with the data tests gating publication.

Silver and gold models are published as versions of season-sliced tables
(:func:`publish_version`): the rows are written once as a staged batch that
no reader sees, the tests read that batch, and only a passing batch is
committed. A failed test, a failed strict cast or a crashed write leaves the
previous version live. :func:`write_audit_publish` is the plain-Parquet form
(checkpoint, test, overwrite) for consumers that need a single folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.audit import MART_TESTS, Tests, audit, observed
from strata.paths import GOLD, SILVER, dataset_location
from strata.plans import marts
from strata.session import work_root
from strata.sources.catalog import materialise, register
from strata.sources.ingest import load_bronze, read_bronze
from strata.sources.versioned import SliceTable
from strata.specs import Dataset


def write_audit_publish(df: DataFrame, tests: Tests, path: str, partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Materialise, test, then publish ``df`` at ``path``; raises on a failed test.

    Plain Parquet output: the overwrite itself is not atomic. See
    :func:`publish_version` for an atomic, versioned publication.
    """
    frozen = _frozen(df)
    results = audit(frozen, tests)
    materialise(frozen, path, partition_by=tuple(partition_by))
    return results


def _frozen(df: DataFrame) -> DataFrame:
    work_root(df.sparkSession)  # makes sure a shared checkpoint folder is configured
    return df.checkpoint(eager=True)


def publish_version(
    df: DataFrame, tests: Tests, path: str, slice_column: str | None = "season", slice_type: str = "int"
) -> tuple[SliceTable, int]:
    """Write, test and publish ``df`` as the next version of a slice table at ``path``.

    The rows are written once, as a staged batch no reader sees; NULLs are counted
    by that write, the unique tests read the batch once; only if all pass is it
    committed. A full rebuild: every
    slice is replaced, slices that vanished are emptied. A failed test or a
    crashed write never exposes a partial mart, and earlier versions stay
    readable. Slicing by season gives a Hive layout whose one-season reads
    list one folder.
    """
    table = SliceTable(df.sparkSession, path, slice_column, slice_type)
    stamped = df if slice_column is None else df.withColumn(slice_column, F.col(slice_column).cast("string"))
    counted, nulls = observed(stamped, tests)  # the write counts NULLs as it goes
    staged = table.stage(counted)  # written once, invisible until committed
    audit(table.read_staged(staged, schema=df.schema), tests, nulls)
    version = table.commit(staged, operation="PUBLISH", replace_all=True)
    return table, version


def build_silver(spark: SparkSession, dataset: Dataset, root: str | None = None) -> dict[str, DataFrame]:
    """Rebuild every staging model as the next version of its season-sliced table.

    A strict cast that fails aborts the staged write, so nothing is committed
    and the previous silver stays live.
    """
    raw = read_bronze(spark, dataset, root)
    out = {}
    for name, model in dataset.models.items():
        df = model(raw)
        path = dataset_location(SILVER, dataset.name, name, root, ext="slices")
        table, _ = publish_version(df, Tests(), path)
        out[name] = register(spark, name, table.read(schema=df.schema))
    return out


def build_gold(spark: SparkSession, dataset: Dataset, silver: dict[str, DataFrame], root: str | None = None) -> dict[str, DataFrame]:
    models = {
        "mart_country_race_summary": marts.country_summary(silver["stg_races"]),
        "mart_driver_standings": marts.driver_standings(
            silver["stg_results"], silver["stg_drivers"], silver["stg_sprint_results"]
        ),
        "mart_constructor_standings": marts.constructor_standings(
            silver["stg_results"], silver["stg_sprint_results"]
        ),
    }
    out = {}
    for name, df in models.items():
        path = dataset_location(GOLD, dataset.name, name, root, ext="slices")
        table, _ = publish_version(df, MART_TESTS[name], path)
        out[name] = register(spark, name, table.read(schema=df.schema))
    return out


def build_all(
    spark: SparkSession, dataset: Dataset, keys: Sequence[str] | None = None, root: str | None = None
) -> dict[str, DataFrame]:
    """Load bronze for ``keys``, rebuild silver and gold; returns the gold frames."""
    load_bronze(spark, dataset, keys, root)
    silver = build_silver(spark, dataset, root)
    return build_gold(spark, dataset, silver, root)


GOLD_MODELS = ("mart_country_race_summary", "mart_driver_standings", "mart_constructor_standings")


def open_gold(spark: SparkSession, dataset: str, root: str | None = None, version: int | None = None) -> dict[str, DataFrame]:
    """Register the published marts (current or as of ``version``) as views by name."""
    out = {}
    for name in GOLD_MODELS:
        table = SliceTable(spark, dataset_location(GOLD, dataset, name, root, ext="slices"), "season", "int")
        out[name] = register(spark, name, table.read(version=version))
    return out
