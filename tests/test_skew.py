"""One key holding a third of the rows: results stay exact, plans stay combinable."""

import contextlib
import io

from pyspark.sql import functions as F

from strata.operators import aggs
from strata.plans import marts


def hot_results(spark, n=30000):
    """A third of the rows belong to driver 0 / team T0; the rest spread out."""
    base = spark.range(n).select(
        F.lit(2024).alias("season"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("driver_id"),
        F.when(F.col("id") % 3 == 0, F.lit("T0")).otherwise(F.concat(F.lit("T"), (F.col("id") % 13).cast("string"))).alias("constructor_name"),
        (F.col("id") % 26).cast("double").alias("points"),
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("int")).otherwise((F.col("id") % 20 + 1).cast("int")).alias("finishing_position"),
        (F.col("id") % 20 + 1).cast("int").alias("grid_position"),
    )
    return base


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_driver_is_exact(spark):
    res = hot_results(spark).repartition(8)
    drivers = spark.range(0, 998).select(
        F.lit(2024).alias("season"), F.col("id").alias("driver_id"),
        F.concat(F.lit("D"), F.col("id").cast("string")).alias("full_name"),
        F.lit(None).cast("string").alias("driver_code"), F.lit("N").alias("nationality"),
        F.lit(None).cast("date").alias("date_of_birth"),
    )
    sprints = res.limit(0)
    out = marts.driver_standings(res, drivers, sprints)
    hot = out.filter("driver_id = 0").first()
    want = res.filter("driver_id = 0").agg(
        F.count(F.lit(1)).alias("n"), F.sum("points").alias("p"), F.count_if(F.col("finishing_position").isNull()).alias("d")
    ).first()
    assert (hot["races_entered"], hot["race_points"], hot["dnfs"]) == (want["n"], want["p"], want["d"])
    assert hot["primary_constructor"] == "T0"
    assert out.count() == 998
    text = plan(out)
    # every aggregate is split into a map-side partial and a final step
    assert text.count("partial_sum(points") >= 1
    assert "partial_min_by" in text


def test_two_level_aggregates_combine_map_side(spark):
    res = hot_results(spark)
    text = plan(aggs.mode(res, ["season", "driver_id"], "constructor_name"))
    assert "partial_count" in text and "partial_min_by" in text
    text = plan(aggs.string_agg_distinct(res, ["season", "driver_id"], "constructor_name"))
    # the distinct step is a partial + final aggregate before the list is built
    assert text.count(" HashAggregate(keys=[") >= 2 and "partial_listagg" in text


def test_hot_key_inner_join_exact_with_skew_handling(spark):
    res = hot_results(spark).repartition(8)
    drivers = spark.range(0, 998).select(F.lit(2024).alias("season"), F.col("id").alias("driver_id"),
                                         (F.col("id") % 5).cast("string").alias("nationality"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = res.join(drivers, ["driver_id", "season"])
        assert joined.count() == 30000
        assert joined.filter("driver_id = 0").count() == 10000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
