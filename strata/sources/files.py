"""File sources and sinks (CSV, Parquet, JSON, ...) with declared schemas.

The same output contract as the page reader: a DataFrame of records. A
declared schema avoids an inference pass over the files, which at scale is a
full extra read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.pages import PAGE_KEY, endpoint_location


def read_files(
    spark: SparkSession,
    fmt: str,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    **options: object,
) -> DataFrame:
    """One scan of a location, or of a list of them."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def write_files(df: DataFrame, fmt: str, path: str, mode: str = "overwrite", **options: object) -> str:
    writer = df.write.format(fmt).mode(mode)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(path)
    return path


def file_reader(fmt: str, path: str, schema: T.StructType | str | None = None, **options: object):
    """A source reader (see ``strata.specs``) over files; unpartitioned."""

    def read(spark: SparkSession, keys=None) -> DataFrame:
        return read_files(spark, fmt, path, schema, **options)

    return read


def key_of_path(template: str) -> Column:
    """The key that ``{partition}`` stands for in a row's file, taken from its path."""
    path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", template)
    before, after = (re.escape(x) for x in path.split("{partition}", 1))
    before, after = (x.replace(re.escape("*"), "[^/]*") for x in (before, after.replace(re.escape("{partition}"), "[^/]+")))
    found = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), f"{before}([^/]+?){after}(/|$)", 1)
    return F.when(found == "", F.raise_error(F.concat(F.lit("no key in the path "), F.col("_metadata.file_path")))).otherwise(found)


def templated_file_reader(
    fmt: str, template: str, schema: T.StructType | str | None = None, rescue: str | None = None, **options: object
):
    """A partitioned file source: ``{partition}`` in ``template`` is filled per key.

    The locations of all keys are one scan, whatever their number, and each row's
    key is read off its file's path, so the load stamps it into the slice column.
    Without a placeholder (or without keys) the location is read verbatim and
    unpartitioned. ``rescue`` names a string column that holds the text of CSV and JSON
    rows that don't fit the schema (their fields that do are read); a row that
    fits, and any row of other formats, has NULL there. It needs a declared schema.
    """

    def read(spark: SparkSession, keys=None) -> DataFrame:
        wanted, settings = schema, dict(options)
        if rescue:
            fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            wanted = T.StructType([*fields.fields, T.StructField(rescue, T.StringType())])
            if fmt in ("csv", "json"):
                settings |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescue}
        if keys is None or "{partition}" not in template:
            return read_files(spark, fmt, template, wanted, **settings)
        rows = read_files(spark, fmt, [endpoint_location(template, str(k)) for k in keys], wanted, **settings)
        return rows.withColumn(PAGE_KEY, key_of_path(template))

    return read
