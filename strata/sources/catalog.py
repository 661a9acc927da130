"""Materialise models as Parquet and expose them by name.

``materialise`` is a full rebuild that replaces the output path; ``register``
puts a frame or a Parquet path behind a name that later SQL resolves;
``serving_view`` is the cached ``SELECT *`` extract dashboards read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.versioned import BATCH, NO_SLICE, SliceTable


def materialise(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    single_file: bool = False,
) -> str:
    """Write ``df`` to ``path`` as Parquet, replacing what was there.

    ``partition_by`` gives a Hive layout (e.g. by season) that later reads
    prune. ``single_file`` is an opt-in for small marts only: it funnels the
    whole output through one task.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def register(spark: SparkSession, name: str, source: DataFrame | str) -> DataFrame:
    """Make ``source`` (a frame or a Parquet path) queryable as ``name``."""
    df = spark.read.parquet(source) if isinstance(source, str) else source
    df.createOrReplaceTempView(name)
    return df


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog table over a Parquet folder, kept across sessions by the metastore."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        # a Hive-partitioned folder: register the partitions found on disk
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
    return spark.table(name)


def serving_view(spark: SparkSession, name: str, source: DataFrame | str, cache: bool = False) -> DataFrame:
    """``SELECT *`` extract of a mart under ``name``; ``cache`` when many queries share it."""
    df = register(spark, name, source)
    if cache:
        spark.catalog.cacheTable(name)
    return spark.table(name)


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """Read one silver or gold table."""
    return spark.read.parquet(path)


def register_function(spark: SparkSession, name: str, table: SliceTable, schema: T.StructType) -> None:
    """A SQL table function over a versioned table: ``SELECT ... FROM name('slice', version)``.

    Both arguments may be NULL or left out: all slices, the current version. A row is live if its
    batch is that of the slice's last load up to the version; the slice reaches the
    scan as a partition filter, as do conditions on the function's result.
    """
    rows = table.all_rows(schema)
    rows.createOrReplaceTempView(f"{name}__rows")
    table.loads().createOrReplaceTempView(f"{name}__loads")
    listed = [f.name for f in rows.schema.fields if f.name != BATCH]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != BATCH)
    own = f"r.`{table.slice_column}`" if table.slice_column else f"'{NO_SLICE}'"
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(of_slice STRING DEFAULT NULL, as_of BIGINT DEFAULT NULL)
RETURNS TABLE ({types})
RETURN SELECT {", ".join(f"r.`{c}`" for c in listed)}
FROM {name}__rows r JOIN (
    SELECT slice, max_by({BATCH}, version) AS live FROM {name}__loads
    WHERE {BATCH} <> '' AND (as_of IS NULL OR version <= as_of) GROUP BY slice) l
ON {own} <=> l.slice AND r.{BATCH} = l.live
WHERE of_slice IS NULL OR {own} = of_slice""")


def register_bronze(spark: SparkSession, name: str, table, version: int | None = None, schema=None) -> DataFrame:
    """Expose a versioned bronze table (current or as of ``version``) to SQL as ``name``."""
    return register(spark, name, table.read(version=version, schema=schema))
