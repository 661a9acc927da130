"""Gold marts: standings per (entity, season) and a calendar per (country, season).

Every mart takes its column names as keyword arguments, so the same code runs
on the F1 silver tables and on any other dataset with the same roles
(season, entity, points, finishing position, grid position).

Plan shape: results and sprint rows are tagged and unioned (no shuffle) and
aggregated in one partial (map-side) + final pass per grouping level, so a
mart needs no join between its own aggregates; dimension joins meet one row
per (season, entity). A hot entity is combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import surrogate_key, zero_if_null
from strata.operators.aggs import count_if, mode_from_counts, sorted_list_agg
from strata.operators.joins import attach_after_aggregate
from strata.operators.ordering import asc, desc

# Counting statistics shared by both standings marts (Grand Prix rows only).
COUNT_STATS = ("races_entered", "wins", "podiums", "points_finishes", "dnfs", "pole_positions")

STANDINGS_TAIL = (
    "total_points",
    "race_points",
    "sprint_points",
    *COUNT_STATS,
    "avg_finishing_position",
)


@dataclass(frozen=True)
class NameLookup:
    """Id → name dimension for the team (or entity) column of the results.

    With a lookup the results carry the id; the marts aggregate on the id and
    join the names onto the aggregate, not onto every result row. The result
    is the same as ``results JOIN lookup USING (id)`` followed by a group-by
    on the name (duplicate ids or shared names included), but the join sees
    one row per (season, id) instead of one per result. Worth it when the
    first aggregate shrinks the rows a lot (many results per (season, id));
    when the grouping keys are nearly unique per row it only adds a shuffle.
    """

    frame: DataFrame
    id_col: str
    name_col: str

    def attach(self, df: DataFrame, id_in_df: str, name_out: str) -> DataFrame:
        names = self.frame.select(
            F.col(self.id_col).alias(id_in_df), F.col(self.name_col).alias(name_out)
        )
        return df.join(names, id_in_df, "inner").drop(id_in_df)


SPRINT_FLAG = "_is_sprint"

# Partial measures summed when (season, entity, ...) rows are combined.
PARTIALS = ("race_points", *COUNT_STATS, "_pos_sum", "_pos_n", "sprint_points")


def tag_rows(results: DataFrame, sprints: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``results UNION ALL sprints`` with a flag marking the sprint rows.

    A union adds no shuffle; both kinds are then aggregated in one grouped
    pass instead of two aggregates and a join. Columns a sprint frame lacks
    (e.g. grid position) read as NULL there and only feed Grand Prix measures.
    """
    r = results.select(*[c for c in columns if c in results.columns]).withColumn(SPRINT_FLAG, F.lit(False))
    s = sprints.select(*[c for c in columns if c in sprints.columns]).withColumn(SPRINT_FLAG, F.lit(True))
    return r.unionByName(s, allowMissingColumns=True)


def _stat_aggs(points: str, position: str, grid: str) -> list[Column]:
    """Grand Prix statistics and sprint points of tagged rows, as partial measures."""
    gp = ~F.col(SPRINT_FLAG)
    pos = F.col(position)
    return [
        F.sum(F.when(gp, F.col(points))).alias("race_points"),
        count_if(gp).alias("races_entered"),
        count_if(gp & (pos == 1)).alias("wins"),
        count_if(gp & pos.between(1, 3)).alias("podiums"),
        count_if(gp & pos.between(1, 10)).alias("points_finishes"),
        count_if(gp & pos.isNull()).alias("dnfs"),
        count_if(gp & (F.col(grid) == 1)).alias("pole_positions"),
        F.sum(F.when(gp, pos)).alias("_pos_sum"),
        F.count(F.when(gp, pos)).alias("_pos_n"),
        F.sum(F.when(~gp, F.col(points))).alias("sprint_points"),
    ]


def _sum_partials() -> list[Column]:
    return [F.sum(c).alias(c) for c in PARTIALS]


def _finish(stats: DataFrame, season: str, entity: str, key_name: str, middle: Sequence[str] = ()) -> DataFrame:
    """Entities with Grand Prix rows only, totals, and the output columns.

    The filter is the ``LEFT JOIN`` from the Grand Prix side: sprint-only
    entities drop out. A NULL key never matches in that join, so its sprint
    points count as 0.
    """
    keyed = F.col(season).isNotNull() & F.col(entity).isNotNull()
    sprint = zero_if_null(F.when(keyed, F.col("sprint_points")))
    return stats.filter(F.col("races_entered") > 0).select(
        surrogate_key(season, entity).alias(key_name),
        season,
        entity,
        *middle,
        (F.col("race_points") + sprint).alias("total_points"),
        "race_points",
        sprint.alias("sprint_points"),
        *COUNT_STATS,
        F.try_divide(F.col("_pos_sum"), F.col("_pos_n")).alias("avg_finishing_position"),
    )


def constructor_standings(
    results: DataFrame,
    sprints: DataFrame,
    *,
    season: str = "season",
    entity: str = "constructor_name",
    points: str = "points",
    position: str = "finishing_position",
    grid: str = "grid_position",
    key_name: str = "constructor_season_key",
    sort: bool = False,
    names: NameLookup | None = None,
    names_id: str = "constructor_id",
) -> DataFrame:
    """Championship standings per (entity, season) from results and sprints.

    ``total_points = race_points + COALESCE(sprint_points, 0)``; the counts use
    Grand Prix rows only; ``races_entered`` counts result rows (car entries).
    See :func:`constructor_standings_rows` for the plan.
    """
    group = names_id if names is not None else entity
    rows = tag_rows(results, sprints, [season, group, points, position, grid])
    return constructor_standings_rows(
        rows, season=season, entity=entity, points=points, position=position, grid=grid,
        key_name=key_name, sort=sort, names=names, names_id=names_id,
    )


def constructor_standings_rows(
    rows: DataFrame,
    *,
    season: str = "season",
    entity: str = "constructor_name",
    points: str = "points",
    position: str = "finishing_position",
    grid: str = "grid_position",
    key_name: str = "constructor_season_key",
    sort: bool = False,
    names: NameLookup | None = None,
    names_id: str = "constructor_id",
) -> DataFrame:
    """Constructor standings from tagged rows (``_is_sprint`` marks sprint rows).

    One partial + final aggregate per (season, entity) computes the Grand
    Prix statistics and the sprint points together. With ``names`` the rows
    carry the id ``names_id``; names are attached to the (season, id)
    aggregate and rows of ids sharing a name are combined.
    """
    if names is None:
        stats = rows.groupBy(season, entity).agg(*_stat_aggs(points, position, grid))
    else:
        per_id = rows.groupBy(season, names_id).agg(*_stat_aggs(points, position, grid))
        stats = names.attach(per_id, names_id, entity).groupBy(season, entity).agg(*_sum_partials())
    out = _finish(stats, season, entity, key_name)
    return order_standings(out, season, key_name) if sort else out


DEFAULT_DRIVER_ATTRIBUTES = {
    "driver_name": "full_name",
    "driver_code": "driver_code",
    "nationality": "nationality",
    "date_of_birth": "date_of_birth",
}


def driver_standings(
    results: DataFrame,
    drivers: DataFrame,
    sprints: DataFrame,
    *,
    season: str = "season",
    entity: str = "driver_id",
    team: str = "constructor_name",
    points: str = "points",
    position: str = "finishing_position",
    grid: str = "grid_position",
    attributes: Mapping[str, str] | None = None,
    key_name: str = "driver_season_key",
    sort: bool = False,
    team_names: NameLookup | None = None,
    team_id: str = "constructor_id",
) -> DataFrame:
    """Championship standings per (driver, season) from results, drivers, sprints.

    See :func:`driver_standings_rows` for the semantics and the plan.
    """
    team_key = team if team_names is None else team_id
    rows = tag_rows(results, sprints, [season, entity, team_key, points, position, grid])
    return driver_standings_rows(
        rows, drivers, season=season, entity=entity, team=team, points=points, position=position,
        grid=grid, attributes=attributes, key_name=key_name, sort=sort, team_names=team_names,
        team_id=team_id,
    )


def driver_standings_rows(
    rows: DataFrame,
    drivers: DataFrame,
    *,
    season: str = "season",
    entity: str = "driver_id",
    team: str = "constructor_name",
    points: str = "points",
    position: str = "finishing_position",
    grid: str = "grid_position",
    attributes: Mapping[str, str] | None = None,
    key_name: str = "driver_season_key",
    sort: bool = False,
    team_names: NameLookup | None = None,
    team_id: str = "constructor_id",
) -> DataFrame:
    """Driver standings from tagged rows (``_is_sprint`` marks sprint rows).

    Semantics are those of ``results LEFT JOIN drivers ON (entity, season)``
    grouped per (season, entity), left joined with the sprint points per
    (season, entity), including the repetition a duplicated driver row would
    cause. The plan is one pass over the rows:

    1. aggregate at (season, entity, team): partial Grand Prix measures and
       sprint points;
    2. re-aggregate at (season, entity); the team with the most Grand Prix
       rows becomes ``primary_constructor`` (ties → smallest name, NULL and
       sprint-only teams ignored);
    3. attach the driver attributes to that one row per key, scaling the
       Grand Prix measures (not the sprint points, which the original joins
       per key, not per row) by the number of matching driver rows;
    4. keep entities with Grand Prix rows.
    """
    attrs = dict(attributes or DEFAULT_DRIVER_ATTRIBUTES)
    team_key = team if team_names is None else team_id
    per_team = rows.groupBy(season, entity, team_key).agg(*_stat_aggs(points, position, grid))
    if team_names is not None:
        # (season, driver, team id) rows get their team name, then the rows of
        # ids sharing a name are combined: the same as naming each result row.
        per_team = team_names.attach(per_team, team_id, team).groupBy(season, entity, team).agg(
            *_sum_partials()
        )
    gp_team = F.when(F.col("races_entered") > 0, F.col(team))
    per_driver = per_team.groupBy(season, entity).agg(
        mode_from_counts(gp_team, "races_entered").alias("primary_constructor"),
        *_sum_partials(),
    )
    scaled = ["race_points", *COUNT_STATS]
    stats = attach_after_aggregate(per_driver, drivers, [season, entity], attrs, additive=scaled)
    out = _finish(stats, season, entity, key_name, middle=[*attrs.keys(), "primary_constructor"])
    return order_standings(out, season, key_name) if sort else out


def country_summary(
    races: DataFrame,
    *,
    season: str = "season",
    country: str = "circuit_country",
    circuit: str = "circuit_name",
    race_date: str = "race_date",
    lat: str = "circuit_lat",
    long: str = "circuit_long",
    key_name: str = "country_season_key",
    sort: bool = False,
) -> DataFrame:
    """Races per (country, season): count, distinct circuits, date range, centroid.

    Two levels: (season, country, circuit) first, so the circuit list is
    built from distinct names only; the centroid is a race-weighted mean.
    """
    per_circuit = races.groupBy(season, country, circuit).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(race_date).alias("_first"),
        F.max(race_date).alias("_last"),
        F.sum(lat).alias("_lat_sum"),
        F.count(lat).alias("_lat_n"),
        F.sum(long).alias("_long_sum"),
        F.count(long).alias("_long_n"),
    )
    out = per_circuit.groupBy(season, country).agg(
        F.sum("_n").alias("race_count"),
        sorted_list_agg(circuit).alias("circuits"),
        F.min("_first").alias("first_race_date"),
        F.max("_last").alias("latest_race_date"),
        F.try_divide(F.sum("_lat_sum"), F.sum("_lat_n")).alias("centroid_lat"),
        F.try_divide(F.sum("_long_sum"), F.sum("_long_n")).alias("centroid_long"),
    )
    out = out.select(
        surrogate_key(season, country).alias(key_name),
        season,
        F.col(country).alias("country"),
        "race_count",
        "circuits",
        "first_race_date",
        "latest_race_date",
        "centroid_lat",
        "centroid_long",
    )
    if sort:
        out = out.orderBy(desc(season), desc("race_count"), asc("country"))
    return out


def order_standings(df: DataFrame, season: str, key_name: str) -> DataFrame:
    """``ORDER BY season DESC, total_points DESC, wins DESC`` plus the key as a tie-break."""
    return df.orderBy(desc(season), desc("total_points"), desc("wins"), asc(key_name))
