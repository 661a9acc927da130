"""Column tests run before a model is published.

``unique`` and ``not_null`` return the offending keys or counts as frames;
``audit`` runs a set of them and raises with every failing test's name and
count. The not_null tests can be counted while the model is written
(``observed``); all unique tests share one pass and one partial-aggregated shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class AuditError(Exception):
    def __init__(self, failures: dict[str, int]):
        self.failures = failures
        detail = ", ".join(f"{name}: {n}" for name, n in sorted(failures.items()))
        super().__init__(f"data tests failed ({detail})")


def unique_failures(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL key values that occur more than once, with their counts."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def null_count_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``column_name, null_count`` (all columns in one pass)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")


def not_null_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with NULLs, and how many."""
    return null_count_rows(df, columns).filter(F.col("null_count") > 0)


@dataclass(frozen=True)
class Tests:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Non-NULL values that occur more than once, counted for each of ``keys`` in one pass over all of them."""
    if not keys:
        return {}
    each = [F.struct(F.lit(i).alias("test"), F.col(k).cast("string").alias("value")) for i, k in enumerate(keys)]
    rows = df.select(F.explode(F.array(*each)).alias("x")).select("x.*").where("value IS NOT NULL")
    twice = rows.groupBy("test", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = {r["test"]: r["count"] for r in twice.groupBy("test").count().collect()}  # one for each test
    return {f"unique_{k}": found.get(i, 0) for i, k in enumerate(keys)}


def observed(df: DataFrame, tests: Tests) -> tuple[DataFrame, Observation | None]:
    """``df`` with the not_null tests counted by whatever job writes it, and where to read the counts after."""
    if not tests.not_null:
        return df, None
    found = Observation()
    return df.observe(found, *[F.count_if(F.col(c).isNull()).alias(c) for c in tests.not_null]), found


def run_tests(df: DataFrame, tests: Tests, nulls: Observation | None = None) -> dict[str, int]:
    """Failure count per test name (``unique_<col>``, ``not_null_<col>``); 0 = pass.

    ``nulls``: the counts of :func:`observed`, once the rows are written; then
    only the unique tests read them again.
    """
    results = duplicate_counts(df, tests.unique)
    if nulls is not None:
        results |= {f"not_null_{c}": int(n) for c, n in nulls.get.items()}
    elif tests.not_null:
        for row in null_count_rows(df, tests.not_null).collect():
            results[f"not_null_{row['column_name']}"] = int(row["null_count"])
    return results


def audit(df: DataFrame, tests: Tests, nulls: Observation | None = None) -> dict[str, int]:
    """Run the tests; raise :class:`AuditError` listing every failing one."""
    results = run_tests(df, tests, nulls)
    failed = {k: v for k, v in results.items() if v}
    if failed:
        raise AuditError(failed)
    return results


# Tests declared for the three marts.
MART_TESTS = {
    "mart_country_race_summary": Tests(
        unique=("country_season_key",),
        not_null=("country_season_key", "season", "country", "race_count"),
    ),
    "mart_driver_standings": Tests(
        unique=("driver_season_key",),
        not_null=("driver_season_key", "season", "driver_id", "total_points"),
    ),
    "mart_constructor_standings": Tests(
        unique=("constructor_season_key",),
        not_null=("constructor_season_key", "season", "constructor_name"),
    ),
}
