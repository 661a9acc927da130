"""Reshaping operators: nested arrays to rows, parent fields onto children,
optional shape steps, unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.specs import KEY_COLUMN, RECORD_COLUMN, Shape


def explode_children(
    parents: DataFrame,
    array_field: str,
    carry: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per element of ``array_field``.

    A parent whose array is missing, NULL or empty gives no row (``explode``,
    not ``explode_outer``). Parent fields in ``carry`` are copied onto each
    child and win over same-named child fields; ``keep`` columns (e.g. the
    load key) pass through. Where the parents hold their whole records
    (``RECORD_COLUMN``), each child holds its own, as it stands in the parent's.
    A narrow operation: no shuffle.
    """
    dtype = parents.schema[array_field].dataType
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, T.StructType):
        raise TypeError(f"{array_field} is not an array of structs")
    child_names = [f.name for f in dtype.elementType.fields if f.name not in set(carry)]
    whole = RECORD_COLUMN in parents.columns and isinstance(parents.schema[RECORD_COLUMN].dataType, T.VariantType)
    if not whole:
        exploded = parents.select(*carry, *keep, F.explode(array_field).alias("_child"))
        return exploded.select(*[F.col("_child").getField(n).alias(n) for n in child_names], *carry, *keep)
    inside = F.variant_get(F.col(RECORD_COLUMN), f"$['{array_field}']", "array<variant>")
    both = F.arrays_zip(F.col(array_field).alias("child"), inside.alias("whole"))
    exploded = parents.select(*carry, *keep, F.explode(both).alias("_child"))
    fields = [F.col("_child.child").getField(n).alias(n) for n in child_names]
    return exploded.select(*fields, F.col("_child.whole").alias(RECORD_COLUMN), *carry, *keep)


def apply_shape(df: DataFrame, shape: Shape | None) -> DataFrame:
    """Run an optional shape step; ``None`` lands the records as they are."""
    return df if shape is None else df.transform(shape)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_merge(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames whose schemas grew: missing columns (and nested
    struct fields) become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def results_shape(results_key: str, carry: Sequence[str] = ("season", "round", "raceName")) -> Shape:
    """Shape step for race records nesting per-race result arrays."""

    def shape(races: DataFrame) -> DataFrame:
        keep = [KEY_COLUMN] if KEY_COLUMN in races.columns else []
        return explode_children(races, results_key, carry=carry, keep=keep)

    return shape
