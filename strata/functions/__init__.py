"""Scalar column functions used by staging, marts and serving."""

from strata.functions.scalars import (
    concat_strict,
    field_path,
    lenient_bigint,
    lenient_date,
    lenient_double,
    lenient_int,
    nullif_empty,
    strict_date,
    strict_double,
    strict_int,
    surrogate_key,
    zero_if_null,
)

__all__ = [
    "concat_strict",
    "field_path",
    "lenient_bigint",
    "lenient_date",
    "lenient_double",
    "lenient_int",
    "nullif_empty",
    "strict_date",
    "strict_double",
    "strict_int",
    "surrogate_key",
    "zero_if_null",
]
