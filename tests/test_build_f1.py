"""End to end on landed F1 pages: bronze → silver → gold → serving, with audits."""

import pytest
from f1_fixture import land_f1
from pyspark.sql import functions as F

from strata.datasets import f1
from strata.operators.audit import AuditError
from strata.paths import GOLD, dataset_location
from strata.plans import build, serve
from strata.sources.ingest import read_bronze


@pytest.fixture(scope="module")
def built(spark):
    import tempfile

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    land_f1(landing)
    ds = f1.dataset(landing)
    gold = build.build_all(spark, ds, root=lake)
    return spark, ds, lake, gold


def rows_by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bronze_explode_and_stamp(built):
    spark, ds, lake, _ = built
    raw = read_bronze(spark, ds, lake)
    res = raw["raw_results"]
    # 2023: 4 results; 2024: 2 + 1 (split page) + 3 + 2 + 2; races without results add nothing
    counts = {r["season"]: r["count"] for r in res.groupBy("season").count().collect()}
    assert counts == {"2023": 4, "2024": 10}
    r1 = res.filter((F.col("season") == "2024") & (F.col("round") == "1"))
    assert r1.count() == 3
    # the parent's season wins over the record's own
    assert res.filter(F.col("Driver.driverId") == "ver").select("season").distinct().count() == 2
    assert "1999" not in {r["season"] for r in res.select("season").collect()}
    # schema growth: SprintQualifying only in 2024
    races = raw["raw_races"]
    sq = {r["season"]: r["n"] for r in races.groupBy("season").agg(F.count("SprintQualifying").alias("n")).collect()}
    assert sq == {"2023": 0, "2024": 1}


def test_silver_types_and_lenient_casts(built):
    spark, ds, lake, _ = built
    stg = spark.table("stg_results")
    pos = {
        (r["season"], r["round"], r["driver_id"]): (r["position_raw"], r["finishing_position"])
        for r in stg.collect()
    }
    assert pos[(2024, 1, "ghost")] == ("R", None)
    assert pos[(2024, 2, "ham")] == ("", None)
    assert pos[(2024, 1, "ham")] == ("3", 3)
    assert pos[(2024, 2, "nob")] == ("99999999999", None)
    ghost = stg.filter("driver_id = 'ghost'").first()
    assert ghost["race_time_ms"] is None and ghost["fastest_lap_rank"] is None
    drivers = rows_by(spark.table("stg_drivers").filter("season = 2024"), "driver_id")
    assert drivers["nob"]["full_name"] is None and drivers["nob"]["permanent_number"] is None
    assert drivers["ver"]["permanent_number"] == 33
    d23 = rows_by(spark.table("stg_drivers").filter("season = 2023"), "driver_id")
    assert d23["ham"]["permanent_number"] is None
    assert str(d23["ver"]["date_of_birth"]) == "1997-09-30"


def test_driver_mart(built):
    spark, ds, lake, gold = built
    m = rows_by(gold["mart_driver_standings"], "driver_season_key")
    assert set(m) == {"2023-ver", "2023-ham", "2024-ver", "2024-ham", "2024-ghost", "2024-nob"}
    ver = m["2024-ver"]
    assert (ver["race_points"], ver["sprint_points"], ver["total_points"]) == (78.0, 8.0, 86.0)
    assert (ver["races_entered"], ver["wins"], ver["podiums"], ver["points_finishes"]) == (4, 2, 3, 4)
    assert (ver["dnfs"], ver["pole_positions"], ver["avg_finishing_position"]) == (0, 2, 2.25)
    assert ver["primary_constructor"] == "Red Bull" and ver["driver_name"] == "Max Verstappen"
    ham = m["2024-ham"]
    assert ham["primary_constructor"] == "Ferrari"  # 2-2 tie with Mercedes → smallest name
    assert (ham["total_points"], ham["dnfs"], ham["points_finishes"]) == (42.0, 1, 3)
    assert ham["avg_finishing_position"] == pytest.approx(13 / 3)
    ghost = m["2024-ghost"]
    assert ghost["driver_name"] is None and ghost["avg_finishing_position"] is None
    assert (ghost["wins"], ghost["dnfs"], ghost["sprint_points"]) == (0, 1, 0.0)
    assert m["2023-ver"]["sprint_points"] == 0.0 and m["2023-ver"]["total_points"] == 50.0


def test_constructor_and_country_marts(built):
    spark, ds, lake, gold = built
    c = rows_by(gold["mart_constructor_standings"].filter("season = 2024"), "constructor_name")
    assert c["Red Bull"]["total_points"] == 76.0 and c["Red Bull"]["races_entered"] == 3
    assert c["Haas"]["total_points"] == 6.0  # sprint points of a sprint-only driver's team
    assert c["Ferrari"]["sprint_points"] == 0.0
    k = rows_by(gold["mart_country_race_summary"], "country_season_key")
    assert k["2023-Austria"]["circuits"] == "Red Bull Ring" and k["2023-Austria"]["race_count"] == 2
    usa = k["2024-USA"]
    assert usa["circuits"] == "Las Vegas Strip Circuit, Miami International Autodrome"
    assert str(usa["first_race_date"]) == "2024-05-05" and str(usa["latest_race_date"]) == "2024-11-23"
    assert usa["centroid_lat"] == pytest.approx((25.9581 + 36.1147) / 2)


def test_serving_on_built_marts(built):
    spark, ds, lake, gold = built
    d, c = gold["mart_driver_standings"], gold["mart_country_race_summary"]
    t = serve.season_totals(c, d, 2024).first()
    assert (t["countries"], t["races"], t["drivers"], t["total_points"]) == (2, 4, 4, 128.0)
    empty = serve.season_totals(c, d, 1950).collect()
    assert len(empty) == 1 and empty[0]["countries"] == 0 and empty[0]["races"] is None
    assert empty[0]["drivers"] == 0 and empty[0]["total_points"] is None
    top = [r["driver_name"] for r in serve.top_drivers(d, 2024, 5).collect()]
    assert top[:2] == ["Max Verstappen", "Lewis Hamilton"] and len(top) == 4
    sql_top = [r["driver_name"] for r in serve.page_query(spark, "top5", 2024).collect()]
    assert sql_top == top
    nat = serve.points_by_attribute(
        spark.table("stg_results"), spark.table("stg_sprint_results"), spark.table("stg_drivers"), 2024
    )
    assert [(r["nationality"], r["total_points"]) for r in nat.collect()] == [
        ("Dutch", 86.0), ("British", 42.0), ("Japanese", 0.0)
    ]


def test_strict_cast_fails_build(spark, scratch):
    landing, lake = f"{scratch}/landing", f"{scratch}/lake"
    land_f1(landing, grid_text="x")
    ds = f1.dataset(landing)
    with pytest.raises(Exception, match="CAST|cast|x"):
        build.build_all(spark, ds, root=lake)


def test_audit_failure_blocks_publish(spark, scratch):
    rows = [("a", 1), ("a", 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    path = dataset_location(GOLD, "t", "m", scratch)
    from strata.operators.audit import Tests

    with pytest.raises(AuditError) as err:
        build.write_audit_publish(df, Tests(unique=("k",), not_null=("k", "v")), path)
    assert err.value.failures == {"unique_k": 1, "not_null_k": 1}
    import os

    assert not os.path.exists(path)


def test_adhoc_sql_over_bronze(built):
    """A notebook-style scan: numeric order of string columns, limited."""
    spark, ds, lake, _ = built
    from strata.sources import catalog
    from strata.sources.ingest import bronze_table

    spec = {s.name: s for s in ds.sources}["raw_races"]
    table = bronze_table(spark, ds, spec, lake)
    catalog.register_bronze(spark, "raw_races", table)
    rows = spark.sql(
        "SELECT season, round, raceName AS race_name, date AS race_date FROM raw_races "
        "ORDER BY CAST(season AS INT), CAST(round AS INT) LIMIT 3"
    ).collect()
    assert [(r["season"], r["round"]) for r in rows] == [("2023", "1"), ("2023", "2"), ("2024", "1")]
    assert catalog.register_bronze(spark, "raw_races_v0", table, version=0).count() == 6
    per_slice = serve.rows_per_season(spark.table("raw_races"))
    assert [tuple(r) for r in per_slice.collect()] == [("2023", 2), ("2024", 4)]


def test_cli_build_and_serve(spark, capsys):
    import tempfile

    from strata.__main__ import main

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    land_f1(f"{scratch}/landing")
    main(["build", "--landing", f"{scratch}/landing", "--root", f"{scratch}/lake", "--keys", "2023,2024"])
    main(["serve", "--root", f"{scratch}/lake", "--page", "drivers", "--season", "2024"])
    out = capsys.readouterr().out
    assert "mart_driver_standings 6" in out and "Max Verstappen" in out
