"""Formula 1 dataset: landed pages of a paged JSON results API, per season.

Declared record schemas make optional structs (``Time``, ``FastestLap``,
``SprintQualifying``) read as NULL when no record of a page carries them.
All scalars arrive as strings; staging casts them. Beside the declared fields each
record stays as it landed (``record``, a VARIANT), with fields that no schema names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.shaping import results_shape
from strata.plans import staging
from strata.sources.pages import page_inventory, read_pages
from strata.specs import RECORD_COLUMN, Dataset, SourceSpec

DATASET = "f1"

# The seasons loaded by default and the API's paging envelope.
SEASONS = ("2023", "2024")
ENVELOPE_KEY = "MRData"
TOTAL_KEY = "total"
PAGE_SIZE = 30

S = T.StringType()


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names])


def _with(fields: Sequence[str], extra: dict[str, T.DataType]) -> T.StructType:
    out = [T.StructField(n, S) for n in fields]
    out += [T.StructField(n, t) for n, t in extra.items()]
    return T.StructType(out)


LOCATION = _struct("locality", "country", "lat", "long")
CIRCUIT = T.StructType(
    [T.StructField("circuitId", S), T.StructField("circuitName", S), T.StructField("Location", LOCATION)]
)

RACE_RECORD = _with(
    ["season", "round", "date", "time", "raceName", "url"],
    {"Circuit": CIRCUIT, "SprintQualifying": _struct("date", "time")},
)

DRIVER_RECORD = _struct(
    "driverId", "permanentNumber", "code", "givenName", "familyName", "dateOfBirth", "nationality", "url"
)

RESULT_RECORD = _with(
    ["season", "number", "position", "points", "grid", "laps", "status"],
    {
        "Driver": _struct("driverId"),
        "Constructor": _struct("constructorId", "name"),
        "Time": _struct("millis"),
        "FastestLap": _struct("rank", "lap"),
    },
)

SPRINT_RECORD = _with(
    ["season", "position", "points", "grid", "status"],
    {"Driver": _struct("driverId"), "Constructor": _struct("constructorId", "name")},
)

RESULTS_RACE = _with(["season", "round", "raceName"], {"Results": T.ArrayType(RESULT_RECORD)})
SPRINT_RACE = _with(["season", "round", "raceName"], {"SprintResults": T.ArrayType(SPRINT_RECORD)})

# Declared columns of the bronze tables (after shaping, before the season stamp).
_DECLARED = {
    "raw_races": RACE_RECORD,
    "raw_drivers": DRIVER_RECORD,
    "raw_results": _with(
        ["number", "position", "points", "grid", "laps", "status"],
        {
            "Driver": _struct("driverId"),
            "Constructor": _struct("constructorId", "name"),
            "Time": _struct("millis"),
            "FastestLap": _struct("rank", "lap"),
            "round": S,
            "raceName": S,
        },
    ),
    "raw_sprint_results": _with(
        ["position", "points", "grid", "status"],
        {
            "Driver": _struct("driverId"),
            "Constructor": _struct("constructorId", "name"),
            "round": S,
            "raceName": S,
        },
    ),
}

#: Bronze tables as stored: the declared columns and the whole record.
RAW_SCHEMAS = {name: T.StructType([*declared.fields, T.StructField(RECORD_COLUMN, T.VariantType())]) for name, declared in _DECLARED.items()}


def page_reader(
    landing_root: str, endpoint: str, record: T.StructType, container: Sequence[str], json_lines: bool = False
):
    """Reader over ``<landing_root>/<dataset>/<endpoint>/season=<key>/``: one page
    per file (``offset=<n>/page.json``) or, with ``json_lines``, one page per line."""

    def read(spark: SparkSession, keys: Sequence[str] | None) -> DataFrame:
        return read_pages(
            spark,
            f"{landing_root}/{DATASET}/{endpoint}",
            record,
            container,
            keys=keys,
            key_column="season",
            envelope_key=ENVELOPE_KEY,
            total_key=TOTAL_KEY,
            multi_line=not json_lines,
            whole=RECORD_COLUMN,
            rebalance=True,
        )

    return read


def page_lister(landing_root: str, endpoint: str, container: Sequence[str], json_lines: bool = False):
    """The landed pages that ``page_reader`` reads, for the completeness check of a load."""

    def read(spark: SparkSession, keys: Sequence[str] | None) -> DataFrame:
        return page_inventory(
            spark,
            f"{landing_root}/{DATASET}/{endpoint}",
            container,
            keys=keys,
            key_column="season",
            envelope_key=ENVELOPE_KEY,
            total_key=TOTAL_KEY,
            multi_line=not json_lines,
        )

    return read


def sources(landing_root: str, json_lines: bool = False) -> tuple[SourceSpec, ...]:
    """The four bronze sources, reading landed pages under ``landing_root``."""
    reader = partial(page_reader, landing_root, json_lines=json_lines)
    lister = partial(page_lister, landing_root, json_lines=json_lines)
    return (
        SourceSpec(
            "raw_races",
            reader("races", RACE_RECORD, ["RaceTable", "Races"]),
            partition_column="season",
            rebalanced=True,
            shredded=False,
            inventory=lister("races", ["RaceTable", "Races"]),
        ),
        SourceSpec(
            "raw_drivers",
            reader("drivers", DRIVER_RECORD, ["DriverTable", "Drivers"]),
            partition_column="season",
            rebalanced=True,
            shredded=False,
            inventory=lister("drivers", ["DriverTable", "Drivers"]),
        ),
        SourceSpec(
            "raw_results",
            reader("results", RESULTS_RACE, ["RaceTable", "Races"]),
            shape=results_shape("Results"),
            partition_column="season",
            rebalanced=True,
            shredded=False,
            inventory=lister("results", ["RaceTable", "Races"]),
        ),
        SourceSpec(
            "raw_sprint_results",
            reader("sprint", SPRINT_RACE, ["RaceTable", "Races"]),
            shape=results_shape("SprintResults"),
            partition_column="season",
            rebalanced=True,
            shredded=False,
            inventory=lister("sprint", ["RaceTable", "Races"]),
        ),
    )


def dataset(landing_root: str, seasons: Sequence[str] = SEASONS, json_lines: bool = False) -> Dataset:
    return Dataset(
        name=DATASET,
        sources=sources(landing_root, json_lines),
        partitions=tuple(seasons),
        models={
            "stg_races": lambda raw: staging.stg_races(raw["raw_races"]),
            "stg_drivers": lambda raw: staging.stg_drivers(raw["raw_drivers"]),
            "stg_results": lambda raw: staging.stg_results(raw["raw_results"]),
            "stg_sprint_results": lambda raw: staging.stg_sprint_results(raw["raw_sprint_results"]),
        },
        raw_schemas=RAW_SCHEMAS,
    )
