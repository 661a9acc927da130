"""Operators on hand-written and seeded-random inputs."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.functions import scalars as X
from strata.operators import aggs, audit, joins
from strata.operators.shaping import explode_children, union_merge
from strata.plans import marts


def test_lenient_int_matches_duckdb(spark):
    texts = ["1.5", "2.5", "-2.5", "1e3", " 7 ", "NaN", "99999999999", "+4", "R", "", None, "3", "2.4999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(X.lenient_int("t").alias("v")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT TRY_CAST(? AS INTEGER)", [t]).fetchone()[0] for t in texts]
    assert got == want


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(Exception):
        df.select(X.strict_int("t")).collect()


def test_concat_and_key_are_null_strict(spark):
    df = spark.createDataFrame([(2024, "ver"), (None, "x"), (2023, None)], "s int, e string")
    got = [r["k"] for r in df.select(X.surrogate_key("s", "e").alias("k")).collect()]
    assert got == ["2024-ver", None, None]


def test_mode_ties_nulls_and_all_null(spark):
    rows = [("a", "M"), ("a", "M"), ("a", "F"), ("a", "F"), ("a", None), ("a", None), ("a", None),
            ("b", "X"), ("b", "X"), ("b", "X"), ("b", "Y"), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r["k"]: r["v"] for r in aggs.mode(df, ["k"], "v").collect()}
    assert got == {"a": "F", "b": "X", "c": None}


def test_string_agg_distinct(spark):
    rows = [("a", "b"), ("a", "a"), ("a", "b"), ("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r["k"]: r["v"] for r in aggs.string_agg_distinct(df, ["k"], "v").collect()}
    assert got == {"a": "a, b", "c": None}


def test_null_counts_and_rows(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert aggs.null_counts(df).first().asDict() == {"a": 1, "b": 2}
    assert aggs.row_count(df).first()["row_count"] == 3


def test_explode_rules(spark):
    schema = "season string, round string, Results array<struct<season:string, v:string>>"
    df = spark.createDataFrame(
        [("2024", "1", [("1999", "a"), ("1999", "b")]), ("2024", "2", []), ("2024", "3", None)], schema
    )
    out = explode_children(df, "Results", carry=("season", "round"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", "2024", "1"), ("b", "2024", "1")]


def test_union_merge_nested(spark):
    a = spark.createDataFrame([(1, (1,))], "id int, s struct<x:int>")
    b = spark.createDataFrame([(2, (2, 3))], "id int, s struct<x:int, y:int>")
    got = sorted((r["id"], r["s"]["x"], r["s"]["y"]) for r in union_merge([a, b]).collect())
    assert got == [(1, 1, None), (2, 2, 3)]


def test_unique_and_not_null_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3)], "k string, v int")
    assert [tuple(r) for r in audit.unique_failures(df, "k").collect()] == [("a", 2)]
    assert sorted(tuple(r) for r in audit.not_null_failures(df, ["k", "v"]).collect()) == [("k", 2), ("v", 1)]
    with pytest.raises(audit.AuditError):
        audit.audit(df, audit.Tests(unique=("k",)))


def _random_facts(spark, seed):
    rnd = random.Random(seed)
    teams = ["A", "B", "C", None]
    facts = [
        (rnd.choice([2023, 2024]), rnd.choice(["d1", "d2", "d3", "d4", None]), rnd.choice(teams),
         float(rnd.randint(0, 25)), rnd.choice([None, 1, 2, 3, 5, 11]), rnd.choice([1, 2, 9]))
        for _ in range(300)
    ]
    dims = [(s, d, f"n-{d}-{s}", rnd.choice(["X", "Y"])) for s in (2023, 2024) for d in ("d1", "d2", "d3")]
    dims += [(2024, "d1", "n-d1-2024", "X")]  # a duplicated driver row fans out
    f = spark.createDataFrame(facts, "season int, driver_id string, constructor_name string, points double, "
                                     "finishing_position int, grid_position int")
    d = spark.createDataFrame(dims, "season int, driver_id string, full_name string, nationality string")
    d = d.withColumn("driver_code", F.lit(None).cast("string")).withColumn("date_of_birth", F.lit(None).cast("date"))
    return f, d


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_driver_mart_equals_row_level_join(spark, seed):
    """The aggregate-then-join mart equals the row-level left join + group-by."""
    facts, dims = _random_facts(spark, seed)
    sprints = facts.sample(fraction=0.3, seed=seed)
    got = marts.driver_standings(facts, dims, sprints)
    facts.createOrReplaceTempView("f")
    dims.createOrReplaceTempView("d")
    sprints.createOrReplaceTempView("sp")
    want = facts.sparkSession.sql("""
        WITH j AS (SELECT f.*, d.full_name, d.nationality FROM f LEFT JOIN d
                   ON f.driver_id = d.driver_id AND f.season = d.season),
        s AS (SELECT season, driver_id, MAX(full_name) AS driver_name, MAX(nationality) AS nationality,
                     SUM(points) AS race_points, COUNT(*) AS races_entered,
                     COUNT_IF(finishing_position = 1) AS wins, COUNT_IF(finishing_position IS NULL) AS dnfs,
                     COUNT_IF(grid_position = 1) AS pole_positions, AVG(finishing_position) AS avg_pos
              FROM j GROUP BY season, driver_id),
        p AS (SELECT season, driver_id, SUM(points) AS sprint_points FROM sp GROUP BY season, driver_id)
        SELECT s.*, s.race_points + COALESCE(p.sprint_points, 0) AS total_points
        FROM s LEFT JOIN p ON s.season = p.season AND s.driver_id = p.driver_id
    """)
    key = ("season", "driver_id")
    g = {tuple(r[k] for k in key): r for r in got.collect()}
    w = {tuple(r[k] for k in key): r for r in want.collect()}
    assert set(g) == set(w)
    for k in w:
        for col in ("driver_name", "nationality", "race_points", "races_entered", "wins", "dnfs",
                    "pole_positions", "total_points"):
            assert g[k][col] == w[k][col], (k, col)
        if w[k]["avg_pos"] is None:
            assert g[k]["avg_finishing_position"] is None
        else:
            assert g[k]["avg_finishing_position"] == pytest.approx(w[k]["avg_pos"])


def test_tie_order_is_fixed_by_key(spark):
    rows = [("2024-b", 2024, "b", 10.0, 1), ("2024-a", 2024, "a", 10.0, 1), ("2024-c", 2024, "c", 12.0, 0)]
    df = spark.createDataFrame(rows, "k string, season int, e string, total_points double, wins long")
    got = [r["e"] for r in marts.order_standings(df, "season", "k").collect()]
    assert got == ["c", "a", "b"]


def test_null_country_sorts_last_and_fails_not_null(spark):
    rows = [(2024, 1, "x", None, "C1", 1.0, 2.0), (2024, 2, "y", "Italy", "C2", 3.0, 4.0),
            (2024, 3, "z", "Italy", "C2", 5.0, 6.0)]
    races = spark.createDataFrame(
        rows, "season int, round int, race_name string, circuit_country string, circuit_name string, "
              "circuit_lat double, circuit_long double"
    ).withColumn("race_date", F.make_date(F.lit(2024), F.col("round"), F.lit(1)))
    out = marts.country_summary(races, sort=True)
    got = [(r["country"], r["country_season_key"], r["race_count"]) for r in out.collect()]
    assert got == [("Italy", "2024-Italy", 2), (None, None, 1)]
    fails = audit.run_tests(out, audit.MART_TESTS["mart_country_race_summary"])
    assert fails["not_null_country"] == 1 and fails["not_null_country_season_key"] == 1


def test_attach_after_aggregate_scales_additive(spark):
    stats = spark.createDataFrame([("k1", 10.0, 2), ("k2", 5.0, 1)], "k string, pts double, n long")
    dims = spark.createDataFrame([("k1", "a"), ("k1", "a")], "k string, name string")
    out = {r["k"]: r for r in joins.attach_after_aggregate(stats, dims, ["k"], {"name": "name"}, ["pts", "n"]).collect()}
    assert (out["k1"]["pts"], out["k1"]["n"], out["k1"]["name"]) == (20.0, 4, "a")
    assert (out["k2"]["pts"], out["k2"]["n"], out["k2"]["name"]) == (5.0, 1, None)
