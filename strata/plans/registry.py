"""Registered queries over the test tables and their DuckDB oracle text.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built by the
library functions on the analogue silver tables (see ``analogue``). The oracle
text computes the same from its definition, in another form than the library's;
both sides alias every computed column identically and round averages to 6
places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import analogue as A
from strata.plans import marts, serve
from strata.sources import catalog

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


def with_silver(body: str) -> str:
    """The analogue silver CTEs, then ``body``: more CTEs and/or the final SELECT."""
    text = body.lstrip()
    joiner = "\n" if text.upper().startswith("SELECT") else ",\n"
    return f"WITH {A.ORACLE_SILVER}{joiner}{text}"


# ------------------------------------------------------------------ marts

# Written from the definitions of the marts: Grand Prix and
# sprint rows are tagged and aggregated together, once per mart. ``w`` repeats a
# driver's Grand Prix rows as often as the driver list does.


def standings_measures(weight: str = "1") -> str:
    """The measures of a standings mart over tagged rows (gp is 1 for Grand Prix rows, else 0)."""
    count = lambda cond: f"CAST(sum(CASE WHEN gp = 1 AND {cond} THEN {weight} ELSE 0 END) AS BIGINT)"
    gp, sprint = f"sum(CASE WHEN gp = 1 THEN points * {weight} END)", "coalesce(sum(CASE WHEN gp = 0 THEN points END), 0)"
    return f"""{gp} + {sprint} AS total_points, {gp} AS race_points, {sprint} AS sprint_points,
           {count("true")} AS races_entered, {count("finishing_position = 1")} AS wins,
           {count("finishing_position <= 3")} AS podiums, {count("finishing_position <= 10")} AS points_finishes,
           {count("finishing_position IS NULL")} AS dnfs, {count("grid_position = 1")} AS pole_positions,
           avg(CASE WHEN gp = 1 THEN finishing_position END) AS avg_finishing_position"""


ORACLE_TAGGED = """
tagged AS (
    SELECT 1 AS gp, season, driver_id, constructor_name, points, finishing_position, grid_position FROM stg_results
    UNION ALL
    SELECT 0, season, driver_id, constructor_name, points, NULL, NULL FROM stg_sprint_results
)"""

ORACLE_CONSTRUCTOR_MART = f"""
mart_constructor_standings AS (
    SELECT concat(season, '-', constructor_name) AS constructor_season_key, season, constructor_name,
           {standings_measures()}
    FROM tagged
    WHERE gp = 1 OR constructor_name IS NOT NULL
    GROUP BY ALL
    HAVING max(gp) = 1
)"""

ORACLE_DRIVER_MART = f"""
listed AS (
    SELECT driver_id, season, count(*) AS copies, min(full_name) AS driver_name, min(driver_code) AS driver_code,
           min(nationality) AS nationality, min(date_of_birth) AS date_of_birth
    FROM stg_drivers GROUP BY ALL
),
home_team AS (
    SELECT driver_id, season, min(struct_pack(fewer := -entries, team := constructor_name)).team AS primary_constructor
    FROM (SELECT driver_id, season, constructor_name, count(*) AS entries
          FROM stg_results WHERE constructor_name IS NOT NULL GROUP BY ALL)
    GROUP BY ALL
),
driver_totals AS (
    SELECT season, driver_id, {standings_measures("w")}
    FROM (SELECT tagged.*, coalesce(copies, 1) AS w FROM tagged LEFT JOIN listed USING (driver_id, season))
    GROUP BY ALL
    HAVING max(gp) = 1
),
mart_driver_standings AS (
    SELECT concat(season, '-', driver_id) AS driver_season_key, driver_totals.*,
           driver_name, driver_code, nationality, date_of_birth, primary_constructor
    FROM driver_totals LEFT JOIN listed USING (driver_id, season) LEFT JOIN home_team USING (driver_id, season)
)"""

ORACLE_COUNTRY_MART = """
mart_country_race_summary AS (
    SELECT concat(season, '-', circuit_country) AS country_season_key, season, circuit_country AS country,
           count(*) AS race_count, array_to_string(list_sort(list_distinct(list(circuit_name))), ', ') AS circuits,
           min(race_date) AS first_race_date, max(race_date) AS latest_race_date,
           sum(circuit_lat) / count(circuit_lat) AS centroid_lat, sum(circuit_long) / count(circuit_long) AS centroid_long
    FROM stg_races
    GROUP BY ALL
)"""

ALL_MARTS = f"{ORACLE_TAGGED},\n{ORACLE_CONSTRUCTOR_MART},\n{ORACLE_DRIVER_MART},\n{ORACLE_COUNTRY_MART}"


def constructor_mart(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    """M3 on the analogue: one scan of lines for Grand Prix and sprint rows,
    aggregated per (season, supplier id), named afterwards. ``season``: that one's rows only."""
    return marts.constructor_standings_rows(
        A.tagged_result_rows(spark, sf_dir, named=False, season=season), names=A.team_names(spark, sf_dir)
    )


def driver_mart(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    """M2 on the analogue.

    Team names are joined per result row here: (season, customer, supplier)
    is nearly unique per line, so aggregating on the team id first would not
    shrink the rows and would only add a shuffle (unlike M3, see above).
    """
    return marts.driver_standings_rows(A.tagged_result_rows(spark, sf_dir, season=season), A.drivers(spark, sf_dir, season))


def country_mart(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    return marts.country_summary(A.races(spark, sf_dir, season))


@register(
    "constructor_standings",
    with_silver(
        f"{ORACLE_TAGGED},\n{ORACLE_CONSTRUCTOR_MART}"
        + """
SELECT * REPLACE (ROUND(avg_finishing_position, 6) AS avg_finishing_position)
FROM mart_constructor_standings"""
    ),
)
def q_constructor_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(constructor_mart(spark, sf_dir), "avg_finishing_position")


@register(
    "driver_standings",
    with_silver(
        f"{ORACLE_TAGGED},\n{ORACLE_DRIVER_MART}"
        + """
SELECT * REPLACE (ROUND(avg_finishing_position, 6) AS avg_finishing_position)
FROM mart_driver_standings"""
    ),
)
def q_driver_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(driver_mart(spark, sf_dir), "avg_finishing_position")


@register(
    "country_summary",
    with_silver(
        ORACLE_COUNTRY_MART
        + """
SELECT * REPLACE (ROUND(centroid_lat, 6) AS centroid_lat, ROUND(centroid_long, 6) AS centroid_long)
FROM mart_country_race_summary"""
    ),
)
def q_country_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(country_mart(spark, sf_dir), "centroid_lat", "centroid_long")


# ------------------------------------------------------------ serving (Q1-Q13)

SEASON = 1997  # the serving queries' bound season parameter


def ordered(mart: str, rounded_cols: tuple[str, ...], order: str) -> str:
    rounds = ", ".join(f"ROUND({c}, 6) AS {c}" for c in rounded_cols)
    return with_silver(f"{ALL_MARTS},\nlast AS (SELECT * REPLACE ({rounds}) FROM {mart} ORDER BY {order})\nSELECT * FROM last")


ORACLE_ORDERED_CONSTRUCTORS = ordered(
    "mart_constructor_standings", ("avg_finishing_position",), "season DESC, total_points DESC NULLS LAST, wins DESC, constructor_season_key"
)
ORACLE_ORDERED_DRIVERS = ordered(
    "mart_driver_standings", ("avg_finishing_position",), "season DESC, total_points DESC NULLS LAST, wins DESC, driver_season_key"
)
ORACLE_ORDERED_COUNTRIES = ordered("mart_country_race_summary", ("centroid_lat", "centroid_long"), "season DESC, race_count DESC, country")


def with_marts(body: str) -> str:
    text = body.lstrip()
    joiner = "\n" if text.upper().startswith("SELECT") else ",\n"
    return with_silver(f"{ALL_MARTS}{joiner}{text}")


@register(
    "season_totals",
    with_marts(
        f"""
SELECT
  (SELECT COUNT(*) FROM mart_country_race_summary WHERE season = {SEASON}) AS countries,
  (SELECT CAST(SUM(race_count) AS BIGINT) FROM mart_country_race_summary WHERE season = {SEASON}) AS races,
  (SELECT COUNT(*) FROM mart_driver_standings WHERE season = {SEASON}) AS drivers,
  (SELECT SUM(total_points) FROM mart_driver_standings WHERE season = {SEASON}) AS total_points
"""
    ),
)
def q_season_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.season_totals(country_mart(spark, sf_dir, SEASON), driver_mart(spark, sf_dir, SEASON), SEASON)


@register(
    "top5_drivers",
    with_marts(
        f"""
top5 AS (
    SELECT driver_name, driver_code, primary_constructor AS team, total_points, wins, podiums
    FROM mart_driver_standings WHERE season = {SEASON}
    ORDER BY total_points DESC NULLS LAST, driver_id LIMIT 5)
SELECT * FROM top5"""
    ),
)
def q_top5_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.top_drivers(driver_mart(spark, sf_dir, SEASON), SEASON, 5)


ORACLE_SEASON_DRIVERS = f"""
standings AS (
    SELECT driver_name, driver_code, primary_constructor AS team, nationality,
           total_points, sprint_points, wins, podiums, points_finishes, pole_positions, dnfs,
           ROUND(avg_finishing_position, 1) AS avg_finish
    FROM mart_driver_standings WHERE season = {SEASON}
    ORDER BY total_points DESC NULLS LAST, driver_id)
SELECT * FROM standings"""


@register("season_drivers", with_marts(ORACLE_SEASON_DRIVERS))
def q_season_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.season_driver_table(driver_mart(spark, sf_dir, SEASON), SEASON)


@register("season_drivers_sql", with_marts(ORACLE_SEASON_DRIVERS))
def q_season_drivers_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same page as SQL text over a registered view, season bound as ``:season``."""
    catalog.serving_view(spark, "mart_driver_standings", driver_mart(spark, sf_dir))
    return serve.page_query(spark, "drivers", SEASON)


@register(
    "season_constructors",
    with_marts(
        f"""
standings AS (
    SELECT constructor_name, races_entered, total_points, sprint_points, wins, podiums,
           points_finishes, pole_positions, dnfs, ROUND(avg_finishing_position, 1) AS avg_finish
    FROM mart_constructor_standings WHERE season = {SEASON}
    ORDER BY total_points DESC NULLS LAST, constructor_name)
SELECT * FROM standings"""
    ),
)
def q_season_constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.season_constructor_table(constructor_mart(spark, sf_dir, SEASON), SEASON)


@register(
    "season_top10_constructors",
    with_marts(
        f"""
standings AS (
    SELECT constructor_name, races_entered, total_points, sprint_points, wins, podiums,
           points_finishes, pole_positions, dnfs, ROUND(avg_finishing_position, 1) AS avg_finish
    FROM mart_constructor_standings WHERE season = {SEASON}
    ORDER BY total_points DESC NULLS LAST, constructor_name LIMIT 10)
SELECT * FROM standings"""
    ),
)
def q_season_top10_constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.season_constructor_table(constructor_mart(spark, sf_dir, SEASON), SEASON, k=10)


@register(
    "season_top10_drivers",
    with_marts(
        f"""
best AS (
    SELECT driver_name, driver_code, primary_constructor AS team, total_points, wins, podiums
    FROM mart_driver_standings WHERE season = {SEASON}
    ORDER BY total_points DESC NULLS LAST, driver_id LIMIT 10)
SELECT * FROM best"""
    ),
)
def q_season_top10_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.top_drivers(driver_mart(spark, sf_dir, SEASON), SEASON, k=10)


# The marts in their published order (O1-O3); tests/test_order.py checks the order itself.


@register("ordered_constructor_standings", ORACLE_ORDERED_CONSTRUCTORS)
def q_ordered_constructor_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, names = A.tagged_result_rows(spark, sf_dir, named=False), A.team_names(spark, sf_dir)
    return rounded(marts.constructor_standings_rows(rows, names=names, sort=True), "avg_finishing_position")


@register("ordered_driver_standings", ORACLE_ORDERED_DRIVERS)
def q_ordered_driver_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = marts.driver_standings_rows(A.tagged_result_rows(spark, sf_dir), A.drivers(spark, sf_dir), sort=True)
    return rounded(rows, "avg_finishing_position")


@register("ordered_country_summary", ORACLE_ORDERED_COUNTRIES)
def q_ordered_country_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.country_summary(A.races(spark, sf_dir), sort=True), "centroid_lat", "centroid_long")


@register(
    "season_countries",
    with_marts(
        f"""
calendar AS (
    SELECT country, race_count, circuits, first_race_date, latest_race_date,
           ROUND(centroid_lat, 6) AS latitude, ROUND(centroid_long, 6) AS longitude
    FROM mart_country_race_summary WHERE season = {SEASON}
    ORDER BY race_count DESC, country)
SELECT * FROM calendar"""
    ),
)
def q_season_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serve.season_country_table(country_mart(spark, sf_dir, SEASON), SEASON), "latitude", "longitude")


@register(
    "points_by_segment",
    with_silver(
        f"""
gp AS (SELECT driver_id, season, points FROM stg_results WHERE season = {SEASON}),
sp AS (SELECT driver_id, season, points FROM stg_sprint_results WHERE season = {SEASON}),
both_ AS (SELECT * FROM gp UNION ALL SELECT * FROM sp)
SELECT d.nationality, SUM(b.points) AS total_points
FROM both_ b JOIN stg_drivers d ON b.driver_id = d.driver_id AND b.season = d.season
GROUP BY d.nationality
ORDER BY total_points DESC NULLS LAST, d.nationality
LIMIT 10"""
    ),
)
def q_points_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.points_by_attribute(
        A.tagged_result_rows(spark, sf_dir, named=False, season=SEASON), None, A.drivers(spark, sf_dir, SEASON), SEASON
    )


@register(
    "sprint_points_by_season",
    with_silver(
        """
SELECT season, SUM(points) AS sprint_points_awarded FROM stg_sprint_results GROUP BY season"""
    ),
)
def q_sprint_points_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.points_per_season(A.sprint_results(spark, sf_dir, named=False))


@register(
    "rows_per_season",
    with_silver(
        """
SELECT season, COUNT(*) AS race_count FROM stg_races GROUP BY season"""
    ),
)
def q_rows_per_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.rows_per_season(A.race_dates(spark, sf_dir))


@register(
    "seasons_present",
    with_silver(
        """
SELECT DISTINCT season FROM stg_results"""
    ),
)
def q_seasons_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.distinct_sorted(A.results(spark, sf_dir, named=False), "season")


@register(
    "alltime_top5",
    with_marts(
        """
top5 AS (
    SELECT * REPLACE (ROUND(avg_finishing_position, 6) AS avg_finishing_position)
    FROM mart_driver_standings
    ORDER BY total_points DESC NULLS LAST, driver_season_key LIMIT 5)
SELECT * FROM top5"""
    ),
)
def q_alltime_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serve.alltime_top(driver_mart(spark, sf_dir), 5), "avg_finishing_position")


def raw_races_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped races: every field a string, as landed from JSON."""
    return A.race_dates(spark, sf_dir).select(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.col("race_name").alias("raceName"),
        F.col("race_date").cast("string").alias("date"),
    )


@register(
    "first_orders",
    with_silver(
        """
raw_races AS (
    SELECT CAST(season AS VARCHAR) AS season, CAST(round AS VARCHAR) AS round,
           race_name AS "raceName", CAST(race_date AS VARCHAR) AS date
    FROM stg_races)
SELECT season, round, "raceName", date FROM raw_races
ORDER BY CAST(season AS INTEGER), CAST(round AS INTEGER), CAST("raceName" AS BIGINT)
LIMIT 10"""
    ),
)
def q_first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = raw_races_text(spark, sf_dir).withColumn("_tie", F.col("raceName").cast("bigint"))
    return serve.first_by_numeric_text(bronze, 10, tie="_tie")



FLAGSHIP = "constructor_standings"

# Importing the second registry module adds its queries.
from strata.plans import registry_ingest, registry_loads  # noqa: E402,F401
