"""Queries whose order is part of the result, row by row against DuckDB's order."""

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.analogue import TABLES
from test_registry import SF_DIR, pytestmark  # noqa: F401
from tools.oracle_check import norm

ORDERED = [
    "ordered_constructor_standings", "ordered_driver_standings", "ordered_country_summary", "season_drivers", "season_constructors", "season_countries", "top5_drivers", "season_top10_drivers", "season_top10_constructors",
    "alltime_top5", "points_by_segment",
]


@pytest.mark.parametrize("name", ORDERED)
def test_order(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = [tuple(norm(x) for x in row) for row in cur.fetchall()]
    got = [tuple(norm(x) for x in row) for row in E.queries()[name](spark, SF_DIR).select(*names).collect()]
    assert got == want
