"""Silver staging models: rename, flatten, cast.

Strict casts (``CAST``) raise on bad text while ANSI mode is on, so a bad
``grid`` or ``laps`` fails the build; lenient casts (``TRY_CAST``) turn text
such as ``'R'`` into NULL. Each model is a single narrow ``select``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import (
    concat_strict,
    field_path,
    lenient_bigint,
    lenient_int,
    nullif_empty,
    strict_date,
    strict_double,
    strict_int,
)


def _f(*path: str):
    return field_path(*path)


def stg_races(raw: DataFrame) -> DataFrame:
    """One row per race; Circuit and Circuit.Location flattened."""
    return raw.select(
        strict_int("season").alias("season"),
        strict_int("round").alias("round"),
        strict_date("date").alias("race_date"),
        F.col("time").alias("race_time_utc"),
        F.col("raceName").alias("race_name"),
        F.col("url").alias("race_url"),
        _f("Circuit", "circuitId").alias("circuit_id"),
        _f("Circuit", "circuitName").alias("circuit_name"),
        _f("Circuit", "Location", "locality").alias("circuit_locality"),
        _f("Circuit", "Location", "country").alias("circuit_country"),
        strict_double(_f("Circuit", "Location", "lat")).alias("circuit_lat"),
        strict_double(_f("Circuit", "Location", "long")).alias("circuit_long"),
    )


def stg_drivers(raw: DataFrame) -> DataFrame:
    """One row per (driver, season); ``full_name`` is NULL when a part is missing."""
    return raw.select(
        strict_int("season").alias("season"),
        F.col("driverId").alias("driver_id"),
        lenient_int(nullif_empty("permanentNumber")).alias("permanent_number"),
        F.col("code").alias("driver_code"),
        F.col("givenName").alias("given_name"),
        F.col("familyName").alias("family_name"),
        concat_strict("givenName", F.lit(" "), "familyName").alias("full_name"),
        strict_date("dateOfBirth").alias("date_of_birth"),
        F.col("nationality").alias("nationality"),
        F.col("url").alias("driver_url"),
    )


def stg_results(raw: DataFrame) -> DataFrame:
    """One row per (race, driver); keeps the raw position beside the parsed one."""
    return raw.select(
        strict_int("season").alias("season"),
        strict_int("round").alias("round"),
        F.col("raceName").alias("race_name"),
        _f("Driver", "driverId").alias("driver_id"),
        _f("Constructor", "constructorId").alias("constructor_id"),
        _f("Constructor", "name").alias("constructor_name"),
        lenient_int("number").alias("car_number"),
        F.col("position").alias("position_raw"),
        lenient_int("position").alias("finishing_position"),
        strict_double("points").alias("points"),
        strict_int("grid").alias("grid_position"),
        strict_int("laps").alias("laps_completed"),
        F.col("status").alias("finish_status"),
        lenient_bigint(_f("Time", "millis")).alias("race_time_ms"),
        lenient_int(_f("FastestLap", "rank")).alias("fastest_lap_rank"),
        lenient_int(_f("FastestLap", "lap")).alias("fastest_lap_number"),
    )


def stg_sprint_results(raw: DataFrame) -> DataFrame:
    """One row per (sprint, driver): identity, classification and points."""
    return raw.select(
        strict_int("season").alias("season"),
        strict_int("round").alias("round"),
        F.col("raceName").alias("race_name"),
        _f("Driver", "driverId").alias("driver_id"),
        _f("Constructor", "constructorId").alias("constructor_id"),
        _f("Constructor", "name").alias("constructor_name"),
        F.col("position").alias("position_raw"),
        lenient_int("position").alias("finishing_position"),
        strict_double("points").alias("points"),
        strict_int("grid").alias("grid_position"),
        F.col("status").alias("finish_status"),
    )
