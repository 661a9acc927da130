"""Properties that must hold on any input (run on the sf0.001 tables)."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.shaping import explode_children
from strata.plans import analogue as A
from strata.plans import registry as R
from strata.plans.registry_ingest import RACE_WITH_RESULTS
from strata.sources.versioned import SliceTable

SF_DIR = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def test_total_is_race_plus_sprint(spark):
    for mart in (R.constructor_mart(spark, SF_DIR), R.driver_mart(spark, SF_DIR)):
        bad = mart.filter(F.col("total_points") != F.col("race_points") + F.col("sprint_points"))
        assert bad.count() == 0


def test_races_entered_sums_to_result_rows(spark):
    results = A.results(spark, SF_DIR).count()
    for mart in (R.constructor_mart(spark, SF_DIR), R.driver_mart(spark, SF_DIR)):
        assert mart.agg(F.sum("races_entered")).first()[0] == results


def test_counts_are_bounded_by_entries(spark):
    mart = R.driver_mart(spark, SF_DIR)
    bad = mart.filter(
        (F.col("wins") > F.col("podiums"))
        | (F.col("podiums") > F.col("points_finishes"))
        | (F.col("points_finishes") + F.col("dnfs") > F.col("races_entered"))
    )
    assert bad.count() == 0


def test_explode_count_is_sum_of_array_sizes(spark):
    parents = A.nested_order_json(spark, SF_DIR).select(
        F.from_json("json", RACE_WITH_RESULTS).alias("r")
    ).select("r.*")
    expected = parents.agg(F.sum(F.coalesce(F.size("Results"), F.lit(0)))).first()[0]
    got = explode_children(parents, "Results", carry=("season", "round", "raceName")).count()
    assert got == expected == A.table(spark, SF_DIR, "lineitem").count()


def test_reload_is_idempotent(spark, scratch):
    events = A.table(spark, SF_DIR, "events")
    table = SliceTable(spark, f"{scratch}/events", "event_type")
    table.load(events)
    first = sorted(tuple(r) for r in table.read().select("event_id", "event_type", "value").collect())
    table.load(events)
    second = sorted(tuple(r) for r in table.read().select("event_id", "event_type", "value").collect())
    assert first == second and len(first) == events.count()
    assert table.version() == 1
