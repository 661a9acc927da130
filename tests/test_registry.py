"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry
from strata.plans.analogue import TABLES
from tools.oracle_check import digest, norm

SF_DIR = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "constructor_season_key"


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_DIR)
    cols = sorted(sdf.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    orows = [tuple(norm(row[i]) for i in idx) for row in cur.fetchall()]
    assert len(srows) == len(orows)
    assert digest(srows) == digest(orows)
