"""Landed pages: explode rules, partition templates, completeness check."""

import os

import pytest
from conftest import land_page
from pyspark.sql import types as T

from strata.sources.ingest import IncompleteLanding, load_bronze, read_bronze
from strata.specs import Dataset, SourceSpec
from strata.sources.pages import endpoint_location, missing_pages, missing_ranges, page_inventory, read_pages

REC = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])


def test_read_pages_explodes_records(spark, scratch):
    land_page(scratch, "d", "items", "2024", 0, 3, ["Table", "Items"], [{"id": "1"}, {"id": "2", "v": "x"}])
    land_page(scratch, "d", "items", "2024", 30, 3, ["Table", "Items"], [])
    land_page(scratch, "d", "items", "2023", 0, 1, ["Table", "Items"], [{"id": "9"}])
    df = read_pages(spark, f"{scratch}/d/items", REC, ["Table", "Items"], keys=["2024"])
    got = sorted((r["id"], r["v"], r["_page_key"], r["_page_offset"]) for r in df.collect())
    assert got == [("1", None, "2024", 0), ("2", "x", "2024", 0)]
    all_keys = read_pages(spark, f"{scratch}/d/items", REC, ["Table", "Items"])
    assert all_keys.count() == 3


def test_missing_and_early_empty_pages(spark, scratch):
    land_page(scratch, "d", "items", "2024", 0, 70, ["T", "I"], [{"id": "1"}])
    land_page(scratch, "d", "items", "2024", 60, 70, ["T", "I"], [{"id": "2"}])
    land_page(scratch, "d", "items", "2023", 0, 40, ["T", "I"], [{"id": "3"}])
    land_page(scratch, "d", "items", "2023", 30, 40, ["T", "I"], [])
    land_page(scratch, "d", "items", "2022", 0, 0, ["T", "I"], [])
    inv = page_inventory(spark, f"{scratch}/d/items", ["T", "I"])
    miss = sorted(tuple(r) for r in missing_pages(inv, 30).collect())
    assert miss == [("2023", 30, "empty_before_total"), ("2024", 30, "missing")]


def brute_missing(rows, size):
    """What a list of all due offsets lacks."""
    out = set()
    for key in {k for k, *_ in rows if k is not None}:
        totals = [t for k, _, t, _ in rows if k == key and t is not None]
        if totals:
            landed = {o for k, o, _, _ in rows if k == key}
            out |= {(key, o) for o in range(0, max(max(totals), 1), size) if o not in landed}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_equal_the_list_of_due_offsets(spark, seed):
    import random

    rnd = random.Random(seed)
    rows = [("none", None, None, 0), ("empty", 0, 0, 0), ("unseen", None, 95, 1), (None, 0, 30, 1)]
    for key in "abcdefgh":
        total = rnd.choice([0, 1, 9, 10, 11, 300, 1000])
        for page in range(total // 10 + 2):
            for _ in range(rnd.choice([0, 1, 1, 2])):
                rows.append((key, page * 10 + rnd.choice([0, 0, 0, 3]), total if rnd.random() < 0.9 else None, 1))
    inventory = spark.createDataFrame(rows, "key string, offset long, total long, records int")
    want = brute_missing(rows, 10)
    for span in (3, 7, 1 << 16):
        ranges = missing_ranges(inventory, 10, span).collect()
        assert all(r.n_pages == (r.last_offset - r.first_offset) // 10 + 1 for r in ranges)
        assert sum(r.n_pages for r in ranges) == len(want)
        assert {(r.key, o) for r in ranges for o in range(r.first_offset, r.last_offset + 1, 10)} == want
    for chunk in (2, 1 << 16):
        got = missing_pages(inventory, 10, chunk).where("reason = 'missing'").collect()
        assert len(got) == len(want) and {(r.key, r.offset) for r in got} == want


def test_a_large_total_costs_its_landed_pages_only(spark):
    inventory = spark.createDataFrame([("k", 0, 30 * 10**12, 30), ("k", 30 * 10**9, None, 30)], "key string, offset long, total long, records int")
    got = sorted((r.first_offset, r.last_offset, r.n_pages) for r in missing_ranges(inventory, 30).collect())
    assert got == [(30, 30 * 10**9 - 30, 10**9 - 1), (30 * 10**9 + 30, 30 * 10**12 - 30, 10**12 - 10**9 - 1)]


def test_partition_template():
    assert endpoint_location("http://x/{partition}/races.json", "2024") == "http://x/2024/races.json"
    assert endpoint_location("http://x/races.json", "2024") == "http://x/races.json"


def spec_of(root):
    """A source of the landed items with its completeness check."""
    path = ["T", "I"]
    return SourceSpec(
        "raw_items",
        lambda spark, keys: read_pages(spark, f"{root}/d/items", REC, path, keys=keys),
        partition_column="season",
        inventory=lambda spark, keys: page_inventory(spark, f"{root}/d/items", path, keys=keys),
    )


@pytest.fixture
def lake(spark, scratch):
    """A dataset with a good 2024 slice already live, and a function that tries to load it again."""
    for season in ("2023", "2024"):
        land_page(f"{scratch}/good", "d", "items", season, 0, 1, ["T", "I"], [{"id": season}])
    good = Dataset("d", (spec_of(f"{scratch}/good"),), partitions=("2023", "2024"))
    load_bronze(spark, good, root=f"{scratch}/lake")

    def reload(root, keys=("2024",)):
        load_bronze(spark, Dataset("d", (spec_of(root),), partitions=tuple(keys)), keys=list(keys), root=f"{scratch}/lake")

    def live():
        raw = read_bronze(spark, good, f"{scratch}/lake")["raw_items"]
        return sorted((r["season"], r["id"]) for r in raw.collect())

    assert live() == [("2023", "2023"), ("2024", "2024")]
    return reload, live


def write_page(root, text, season="2024", offset=0):
    folder = f"{root}/d/items/season={season}/offset={offset}"
    os.makedirs(folder)
    with open(f"{folder}/page.json", "w") as fh:
        fh.write(text)


@pytest.mark.parametrize(
    "page",
    [
        '{"MRData": {"total": "1", "offset": "0", "T": {"I": [{"id": "1"}',
        '{"error": "too many requests"}',
        '{"MRData": {"total": "1", "offset": "0"}}',
        '{"MRData": {"total": "1", "offset": "0", "T": {}}}',
        "",
    ],
)
def test_a_damaged_page_fails_the_load_and_the_old_slice_stays(spark, scratch, lake, page):
    reload, live = lake
    write_page(f"{scratch}/bad", page)
    with pytest.raises(IncompleteLanding, match="2024"):
        reload(f"{scratch}/bad")
    assert live() == [("2023", "2023"), ("2024", "2024")]
    if page:
        with pytest.raises(Exception, match="damaged page of key 2024 in .*page.json"):
            read_pages(spark, f"{scratch}/bad/d/items", REC, ["T", "I"]).collect()


def test_missing_duplicate_and_absent_pages_fail_the_load(spark, scratch, lake):
    reload, live = lake
    land_page(f"{scratch}/gap", "d", "items", "2024", 0, 40, ["T", "I"], [{"id": "1"}])
    with pytest.raises(IncompleteLanding, match="2024 offset 30: missing"):
        reload(f"{scratch}/gap")
    page = '{"MRData": {"total": "1", "offset": "0", "T": {"I": [{"id": "1"}]}}}'
    write_page(f"{scratch}/twice", page)
    with open(f"{scratch}/twice/d/items/season=2024/offset=0/again.json", "w") as fh:
        fh.write(page)
    with pytest.raises(IncompleteLanding, match="duplicate"):
        reload(f"{scratch}/twice")
    land_page(f"{scratch}/other", "d", "items", "2023", 0, 1, ["T", "I"], [{"id": "x"}])
    with pytest.raises(IncompleteLanding, match="2024 offset None: no page landed"):
        reload(f"{scratch}/other", ("2023", "2024"))
    assert live() == [("2023", "2023"), ("2024", "2024")]


def test_a_landed_total_of_zero_empties_the_slice(spark, scratch, lake):
    reload, live = lake
    land_page(f"{scratch}/none", "d", "items", "2024", 0, 0, ["T", "I"], [])
    reload(f"{scratch}/none")
    assert live() == [("2023", "2023")]
