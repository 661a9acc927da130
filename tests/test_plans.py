"""Physical-plan properties of the registered queries."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E
from strata.plans import registry as R

SF_DIR = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")

# Queries whose callables write data first (their plans read the written files).
WRITES = {"envelope_pages", "missing_pages", "bronze_current", "bronze_as_of", "bronze_history",
          "bronze_schema_growth", "slice_replace", "file_source_csv", "season_drivers_sql",
          "bronze_overwrite", "bronze_sql", "reloaded_driver_totals", "materialised_model"}


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - WRITES))
def test_no_python_and_no_pair_joins(spark, name):
    text = plan_text(E.queries()[name](spark, SF_DIR), "extended")
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in text, f"{name}: {node}"


def test_linestatus_filter_and_pruning_reach_the_scan(spark):
    """One scan of lines serves Grand Prix and sprint rows, filtered at the source."""
    text = plan_text(R.constructor_mart(spark, SF_DIR))
    assert "In(l_linestatus, [F,O])" in text
    assert text.count("lineitem.parquet") == 1
    for unused in ("l_extendedprice", "l_tax", "l_shipdate", "o_totalprice", "o_orderpriority"):
        assert unused not in text


def test_season_filter_is_pushed_below_the_aggregate(spark):
    from strata.plans import serve

    df = serve.season_constructor_table(R.constructor_mart(spark, SF_DIR), 1997)
    text = plan_text(df, "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    agg_at = optimized.find("Aggregate")
    year_filter = optimized.find("year(cast(o_orderdate")
    assert agg_at != -1 and year_filter > agg_at  # filter sits below (printed after) the aggregate


def test_top_k_is_take_ordered(spark):
    from strata.plans import serve

    text = plan_text(serve.top_drivers(R.driver_mart(spark, SF_DIR), 1997, 5))
    assert "TakeOrderedAndProject" in text


def test_driver_mart_joins_reuse_aggregate_partitioning(spark):
    """The attribute and sprint joins add no exchange beyond the aggregates' own."""
    df = R.driver_mart(spark, SF_DIR)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(df, "simple")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Grand Prix and sprint rows are aggregated together (level 1 by team,
    # level 2 by driver), so the only join on (season, driver_id) is the
    # attribute join, and it reuses the aggregates' partitioning: exchanges on
    # season are level 1, level 2, the driver list's distinct and its
    # per-key aggregate, nothing for the join itself.
    assert text.count("SortMergeJoin [season") == 1
    assert text.count("hashpartitioning(season") == 4
    assert text.count("lineitem.parquet") == 1


def test_published_mart_season_read_is_partition_pruned(spark, scratch):
    """Serving a season from a published (season-sliced) mart prunes to its folder."""
    from strata.operators.audit import Tests
    from strata.plans.build import publish_version

    df = spark.createDataFrame([(2023, "a", 1.0), (2024, "b", 2.0)], "season int, k string, v double")
    table, _ = publish_version(df, Tests(), f"{scratch}/mart")
    table.read().createOrReplaceTempView("pruned_mart")
    query = spark.sql("SELECT k, v FROM pruned_mart WHERE season = :s", args={"s": 2024})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan_text(query, "simple")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "= 2024)" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert [r["k"] for r in query.collect()] == ["b"]


def test_a_season_reaches_the_scan_as_a_date_range(spark):
    """Row groups of other years are skipped, whatever page is asked for."""
    for name in ("season_totals", "top5_drivers", "season_drivers", "season_constructors", "season_countries", "points_by_segment", "season_top10_drivers"):
        text = plan_text(E.queries()[name](spark, SF_DIR))
        scans = [part for part in text.split("Scan parquet") if "orders.parquet" in part]
        assert scans, name
        for scan in scans:
            pushed = scan.split("PushedFilters:")[1].split("\n")[0]
            assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in pushed and "LessThan(o_orderdate,1998-01-01" in pushed, (name, pushed)


def test_the_best_of_every_season_are_limited_before_the_shuffle(spark):
    text = plan_text(E.queries()["top10_drivers_by_season"](spark, SF_DIR), "simple")
    assert text.count("WindowGroupLimit") == 2 and ", 10, Partial" in text and ", 10, Final" in text


def test_bitmaps_shuffle_no_ids(spark):
    text = plan_text(E.queries()["constructor_lineups"](spark, SF_DIR), "simple")
    assert "Expand" not in text and "bitmap_construct_agg" in text


def test_a_table_function_prunes_to_its_slice(spark):
    df = E.queries()["bronze_sql"](spark, SF_DIR)
    text = plan_text(df, "simple")
    assert "PartitionFilters: [isnotnull(event_type" in text and "= error)" in text
