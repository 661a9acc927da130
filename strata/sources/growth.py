"""Schemas that grow: whole records of all slices under one schema.

A load of whole records (a VARIANT column, see ``pages.read_pages``) notes the schema
of each slice's records. The schemas of the live slices are joined in a lattice, and
every record is read with the result: fields that a slice's records lack are NULL.

The lattice, from below: VOID (only nulls seen); BIGINT and DECIMAL widen to a DECIMAL
that holds both, or to DOUBLE where 38 digits do not; any of them with DOUBLE gives
DOUBLE; structs join field by field, arrays by their elements. All else that
differs, within a slice or between slices, is text: scalars as such, structs and
arrays as JSON.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalars import type_text
from strata.sources.versioned import SliceTable
from strata.specs import RECORD_COLUMN

_WORD = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<>|\bOBJECT<")


def parse_schema(text: str) -> T.DataType:
    """The type in the notation of ``schema_of_variant_agg``."""
    plain = _WORD.sub(lambda m: {"OBJECT<": "STRUCT<", "OBJECT<>": "STRUCT<>"}.get(m[0], m[0]), text)
    return T.DataType.fromDDL(plain)


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (19, 0)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that both are read as."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both[f.name] = join_types(both[f.name], f.dataType) if f.name in both else f.dataType
        return T.StructType([T.StructField(n, both[n]) for n in sorted(both)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if a == b:
        return a
    exact = (T.LongType, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        whole, part = map(max, zip(_digits(a), _digits(b), strict=True))
        return T.DecimalType(whole + part, part) if whole + part <= 38 else T.DoubleType()
    if isinstance(a, (*exact, T.DoubleType)) and isinstance(b, (*exact, T.DoubleType)):
        return T.DoubleType()
    return T.StringType()


def readable(t: T.DataType) -> T.DataType:
    """A type as records are read with: text for what clashed within a slice, and where only nulls were seen."""
    if isinstance(t, T.StructType):
        # a struct without fields, or with names that differ by case only, can't be a column's type
        names = [f.name.lower() for f in t.fields]
        if not names or len(set(names)) < len(names):
            return T.StringType()
        return T.StructType([T.StructField(f.name, readable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(readable(t.elementType))
    return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t


def joined_schema(schemas: Iterable[str]) -> T.StructType:
    """The schema of records with any of these schemas; records that are no objects have no fields."""
    types = [t for t in map(parse_schema, schemas) if isinstance(t, T.StructType)]
    joined = reduce(join_types, types, T.StructType([]))
    read = readable(joined)
    return read if isinstance(read, T.StructType) else T.StructType([])


def with_fields(rows: DataFrame, schema: T.StructType, record: str = RECORD_COLUMN) -> DataFrame:
    """``rows`` with a column for each field of their whole records; other columns of those names give way."""
    taken = {f.name.lower() for f in schema.fields}
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in taken and c != record]
    if not schema.fields:
        return rows.select(*kept)
    whole = F.variant_get(F.col(record), "$", type_text(schema))
    return rows.select(*kept, whole.alias("_whole")).select(*kept, "_whole.*")


def read_grown(table: SliceTable, version: int | None = None) -> DataFrame:
    """All fields that the records of any live slice have, with the slice column.

    A field named as the slice column gives way to it: the load's key wins.
    """
    live = table.live(version).where("row_count > 0").select("record_schema").distinct()
    schema = joined_schema(r[0] for r in live.collect() if r[0])  # one for each slice at most
    schema = T.StructType([f for f in schema.fields if f.name.lower() != (table.slice_column or "").lower()])
    whole = T.StructType([T.StructField(RECORD_COLUMN, T.VariantType())])
    return with_fields(table.read(version=version, schema=whole), schema)
