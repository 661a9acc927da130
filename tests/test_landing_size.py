"""What landing and loading F1 pages move: lines once to their pages, records once to their slices, packed text."""

import contextlib
import glob
import io
import json
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.datasets import f1
from strata.plans import analogue as A
from strata.sources import growth, ingest
from strata.specs import SourceSpec

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp"


def plan_text(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture
def tables(spark, scratch):
    """Orders of two seasons and one without a date; lines that share an order and a line number, and an order twice."""
    orders = [(k, k % 7, datetime(2023 + k % 2, 1 + k % 12, 3, 4)) for k in range(60)]
    orders += [(5, 3, datetime(2024, 6, 6)), (8, 1, datetime(2023, 6, 6)), (61, 1, None)]
    lines = [(k % 62, 3 * k, k % 5, None if k % 31 == 0 else k % 4, float(k % 50), "ARN"[k % 3], "FO"[k % 2], datetime(2022 + k % 3, 2, 2)) for k in range(400)]
    lines.append((7, None, None, 1, None, None, "F", None))
    spark.createDataFrame(lines, LINES).write.parquet(f"{scratch}/lineitem.parquet")
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{scratch}/orders.parquet")
    return scratch, lines, orders


def expected(lines, orders, status):
    """Race records by season, in order of their parents' keys, their results as a sorted list."""
    parents = {}
    for o, cust, day in orders:
        for x in lines:
            if x[0] == o and x[6] == status and day is not None:
                parents.setdefault((day.year, o, -1 if x[3] is None else x[3], day), []).append((cust, x))
    return parents


@pytest.mark.parametrize("blocks", [1, 3, 7, 4096])
def test_pages_hold_every_race_record_once_in_order(spark, tables, blocks):
    sf_dir, lines, orders = tables
    parents = expected(lines, orders, "F")
    got = {}
    for r in A.race_result_pages(spark, sf_dir, "F", "Results", page_size=4, blocks=blocks).collect():
        page = json.loads(r["json"])["MRData"]
        got[r["season"], int(page["offset"])] = (int(page["total"]), page["RaceTable"]["Races"])
    for season in (2023, 2024):
        mine = sorted(k for k in parents if k[0] == season)
        assert sorted(o for s, o in got if s == str(season)) == list(range(0, len(mine), 4))
        for offset in range(0, len(mine), 4):
            total, races = got[str(season), offset]
            due = mine[offset : offset + 4]
            assert total == len(mine) and len(races) == len(due)
            assert sorted((int(x["raceName"]), int(x["round"])) for x in races) == sorted((k[1], k[3].timetuple().tm_yday) for k in due)
            found = sorted((x["Driver"]["driverId"], x["grid"], x.get("points", ""), x.get("position", ""), x.get("season", "")) for r in races for x in r["Results"])
            want = [
                (str(c), str(x[0] % 20 + 1), "" if x[4] is None else str(int(x[4])), "R" if x[5] == "R" else "" if x[1] is None else str(x[1] % 20 + 1), "" if x[7] is None else str(x[7].year))
                for k in due
                for c, x in parents[k]
            ]
            assert found == sorted(want)
    assert {s for s, _ in got} == {"2023", "2024"}


def test_lines_are_counted_and_placed_from_one_shuffle(spark, tables):
    pages = A.race_result_pages(spark, tables[0], "F", "Results")
    pages.collect()
    final = plan_text(pages).split("Initial Plan")[0]
    moved = [x for x in final.splitlines() if "REPARTITION_BY_COL" in x]
    assert len([x for x in moved if "ReusedExchange" not in x]) == 1 and "ReusedExchange" in final, final


def test_landed_text_is_packed_and_records_move_once_before_their_fields_are_read(spark, tables, scratch):
    landing = f"{scratch}/landing"
    A.land_text_pages(A.race_result_pages(spark, tables[0], "F", "Results"), f"{landing}/f1/results")
    files = glob.glob(f"{landing}/f1/results/season=*/part-*")
    assert files and all(x.endswith(".gz") for x in files)
    ds = f1.dataset(landing, seasons=("2023", "2024"), json_lines=True)
    spec = next(s for s in ds.sources if s.name == "raw_results")
    frame = ingest.bronze_frame(spark, ds, spec, ["2023", "2024"])
    text = plan_text(frame)
    assert text.count("REBALANCE") == 1
    assert "variant_get" in text.split("REBALANCE")[0] and "variant_get" not in text.split("REBALANCE")[1]
    table = ingest.bronze_table(spark, ds, spec, f"{scratch}/lake")
    told = []
    table._write = lambda df, batch, write=table._write: (told.append(plan_text(df).count("REBALANCE")), write(df, batch))
    table.load(frame, ["2023", "2024"], rebalanced=spec.rebalanced)
    assert told == [1] and table.read().count() == frame.count() > 0


@pytest.mark.parametrize("blocks", [1, 7, 4096])
def test_pages_are_texts_of_flat_lines_in_order(spark, tables, blocks):
    """No line is nested or read by an interpreted function on its way, races are counted without their lines."""
    sf_dir, lines, orders = tables
    pages = A.race_result_pages(spark, sf_dir, "F", "Results", page_size=4, blocks=blocks)
    found = {}
    for r in pages.collect():
        page = json.loads(r["json"])
        assert json.dumps(page, separators=(",", ":")) == r["json"]
        found[r["season"], int(page["MRData"]["offset"])] = [x["raceName"] for x in page["MRData"]["RaceTable"]["Races"]]
    due = sorted(expected(lines, orders, "F"))
    assert [x for _, names in sorted(found.items()) for x in names] == [str(k[1]) for k in due]
    text = plan_text(pages)
    assert "lambda" not in text
    assert all("_piece" in x for x in text.splitlines() if "collect_list" in x), text


def test_landed_pages_are_parsed_once_to_be_checked(spark):
    parsed = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: (parsed.add(1), x)[1], "long")
    pages = [(str(2000 + k % 2), 30 * (k // 2), 100, 30 if k < 6 else 10, False) for k in range(8)]

    def inventory(session, keys):
        frame = session.createDataFrame(pages, "key string, offset long, total long, records int, damaged boolean")
        return frame.withColumn("offset", seen("offset"))

    spec = SourceSpec("raw", lambda *_: None, partition_column="season", inventory=inventory)
    kept = set(spark.sparkContext._jsc.getPersistentRDDs())
    ingest.check_landing(spark, spec, ["2000", "2001"])
    assert parsed.value == len(pages)
    with pytest.raises(ingest.IncompleteLanding, match="2002 offset None: no page landed"):
        ingest.check_landing(spark, spec, ["2000", "2001", "2002"])
    assert parsed.value == 2 * len(pages)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= kept


def test_whole_records_of_f1_are_stored_in_one_piece(spark, tables, scratch):
    A.land_text_pages(A.race_result_pages(spark, tables[0], "F", "Results"), f"{scratch}/landing/f1/results")
    ds = f1.dataset(f"{scratch}/landing", seasons=("2023", "2024"), json_lines=True)
    spec = next(s for s in ds.sources if s.name == "raw_results")
    ingest.load_source(spark, ds, spec, root=f"{scratch}/lake")
    table = ingest.bronze_table(spark, ds, spec, f"{scratch}/lake")
    files = glob.glob(f"{table.data_path}/season=*/*/*.parquet")
    assert files and all({x.name for x in pq.read_schema(f).field("record").type} == {"value", "metadata"} for f in files)
    names = {f.name for f in f1.RESULT_RECORD.fields}
    assert names == {f.name for r in table.live().collect() for f in growth.parse_schema(r.record_schema).fields}
    for r in table.read(schema=ds.raw_schemas["raw_results"]).collect():
        assert json.loads(r.record.toJson()).get("points") == r.points
