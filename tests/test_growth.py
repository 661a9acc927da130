"""Whole records: undeclared fields, schemas that grow, the lattice of types."""

import json
import os

import pytest
from conftest import land_page
from f1_fixture import land_f1
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.datasets import f1
from strata.sources import growth
from strata.sources.ingest import load_bronze, read_bronze
from strata.sources.pages import PAGE_KEY, PAGE_OFFSET, read_pages
from strata.sources.versioned import SliceTable

DECLARED = T.StructType([T.StructField("id", T.StringType())])


def landed(spark, root):
    rows = read_pages(spark, root, DECLARED, ["T", "I"], whole="record")
    return rows.withColumn("season", F.col(PAGE_KEY)).drop(PAGE_KEY, PAGE_OFFSET)


def test_fields_that_no_schema_declares_survive(spark, scratch):
    land_f1(f"{scratch}/landing")
    folder = f"{scratch}/landing/f1/results/season=2024/offset=0"
    page = json.load(open(f"{folder}/page.json"))
    races = page["MRData"]["RaceTable"]["Races"]
    races[0]["Results"][0] |= {"penalty": {"seconds": 5, "why": "speeding"}, "season": "1950"}
    json.dump(page, open(f"{folder}/page.json", "w"))
    ds = f1.dataset(f"{scratch}/landing")
    load_bronze(spark, ds, root=f"{scratch}/lake")
    raw = read_bronze(spark, ds, f"{scratch}/lake")
    rows = raw["raw_results"].where(F.variant_get("record", "$.penalty.seconds", "int") == 5).collect()
    assert [(r.season, r.round, r.Driver.driverId) for r in rows] == [("2024", "1", "ver")]
    assert json.loads(rows[0].record.toJson())["penalty"] == {"seconds": 5, "why": "speeding"}
    races = raw["raw_races"].select(F.variant_get("record", "$.Circuit.Location.locality", "string").alias("x")).distinct()
    assert [r.x for r in races.collect()] == ["x"]
    for name, df in raw.items():
        declared = [f.name for f in f1.RAW_SCHEMAS[name].fields if f.name != "record" and isinstance(f.dataType, T.StringType) and f.name not in ("round", "raceName", "season")]
        for r in df.collect():
            whole = json.loads(r.record.toJson())
            assert all(whole.get(c) == r[c] for c in declared)


@pytest.mark.parametrize("page", ['{"MRData": {"total": "1", "T": {}}}', '{"MRData": {"total": "1"', '{"error": 1}', '{"MRData": {"total": "1", "offset": "0", "T": {"I": {"id": "1"}}}}'])
def test_envelope_errors_stay_strict(spark, scratch, page):
    os.makedirs(f"{scratch}/d/season=2024/offset=0")
    open(f"{scratch}/d/season=2024/offset=0/page.json", "w").write(page)
    with pytest.raises(Exception, match="damaged page of key 2024 in .*page.json"):
        landed(spark, f"{scratch}/d").collect()


def test_a_declared_field_of_another_kind_fails(spark, scratch):
    land_page(scratch, "d", "i", "2024", 0, 1, ["T", "I"], [{"id": "1", "n": 3}])
    wrong = T.StructType([T.StructField("n", T.StructType([T.StructField("x", T.StringType())]))])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        read_pages(spark, f"{scratch}/d/i", wrong, ["T", "I"], whole="record").collect()


def test_schemas_grow_from_landing_to_landing(spark, scratch):
    table = SliceTable(spark, f"{scratch}/lake", "season")
    first = [{"id": 1, "n": 1, "who": {"a": 1}, "tags": [1], "odd": 1, "nothing": None}, {"id": 2, "n": 2.5}]
    second = [{"id": "x3", "n": 1e300, "who": {"a": "z", "b": True}, "tags": ["t"], "odd": {"k": [1]}, "new": "2024-01-01", "season": "1900"}]
    for season, records in (("2023", first), ("2024", second)):
        land_page(f"{scratch}/{season}", "d", "i", season, 0, len(records), ["T", "I"], records)
        table.load(landed(spark, f"{scratch}/{season}/d/i"))
    grown = growth.read_grown(table)
    assert dict(grown.dtypes) == {
        "id": "string", "n": "double", "who": "struct<a:string,b:boolean>", "tags": "array<string>", "odd": "string", "nothing": "string", "new": "string", "season": "string"
    }
    rows = {r.id: r for r in grown.collect()}
    assert rows["1"].new is None and rows["1"].who == ("1", None) and rows["1"].tags == ["1"] and rows["1"].odd == "1" and rows["1"].season == "2023"
    assert rows["2"].n == 2.5 and rows["2"].who is None
    assert rows["x3"].who == ("z", True) and rows["x3"].odd == '{"k":[1]}' and rows["x3"].new == "2024-01-01" and rows["x3"].season == "2024"
    old = growth.read_grown(table, version=0)
    assert "new" not in old.columns and dict(old.dtypes)["n"] == "decimal(2,1)" and old.count() == 2
    table.load(spark.createDataFrame([], table.read().schema), ["2024"])
    assert "new" not in growth.read_grown(table).columns


def test_clashes_within_a_slice_and_odd_names(spark, scratch):
    records = [{"id": "1", "a": 1, "OBJECT<": "x", "back`tick": 1, "Case": 1, "case": 2, "e": {}}, {"id": "2", "a": {"b": 1}}, {"id": "3", "a": [True]}]
    table = SliceTable(spark, f"{scratch}/lake", "season")
    land_page(scratch, "d", "i", "2024", 0, 3, ["T", "I"], [{k: v for k, v in r.items() if k != "case"} for r in records])
    table.load(landed(spark, f"{scratch}/d/i"))
    rows = {r.id: r for r in growth.read_grown(table).collect()}
    assert [rows[k].a for k in "123"] == ["1", '{"b":1}', "[true]"]
    assert rows["1"]["OBJECT<"] == "x" and rows["1"]["back`tick"] == 1 and rows["1"].e == "{}" and rows["2"].e is None


SCALARS = [T.NullType(), T.BooleanType(), T.LongType(), T.DecimalType(3, 1), T.DecimalType(38, 0), T.DecimalType(38, 38), T.DoubleType(), T.StringType(), T.DateType(), T.VariantType()]
types = st.recursive(
    st.sampled_from(SCALARS),
    lambda inner: st.one_of(
        inner.map(T.ArrayType),
        st.dictionaries(st.sampled_from("abc"), inner, max_size=3).map(lambda d: T.StructType([T.StructField(n, d[n]) for n in sorted(d)])),
    ),
    max_leaves=6,
)


@given(types, types, types)
def test_the_lattice(a, b, c):
    """Joins don't depend on order, and what is read as a joined type reads all that went into it."""
    join = growth.join_types
    assert join(a, a) == a and join(a, b) == join(b, a)
    assert join(join(a, b), b) == join(a, b)
    if not any(isinstance(x, T.DecimalType) for x in (a, b, c)) and not any("decimal" in x.simpleString() for x in (a, b, c)):
        assert join(join(a, b), c) == join(a, join(b, c))
