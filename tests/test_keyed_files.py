"""One scan for many keys, rescued rows; states merged as a rebuild; profiles."""

import random

from pyspark.sql import functions as F

from strata.operators import profile
from strata.operators.aggs import exact_distinct
from strata.plans import states
from strata.sources.files import templated_file_reader, write_files
from strata.sources.versioned import SliceTable
from strata.specs import KEY_COLUMN


def test_one_scan_node_for_a_thousand_keys(spark, scratch):
    keys = [f"{i:04d}" for i in range(1000)]
    spark.range(1000).select("id", F.format_string("%04d", "id").alias("k")).repartition(4).write.partitionBy("k").parquet(f"{scratch}/in")
    rows = templated_file_reader("parquet", f"{scratch}/in/k={{partition}}/*.parquet", "id long")(spark, keys)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    assert rows.where(F.col(KEY_COLUMN) != F.format_string("%04d", "id")).isEmpty() and rows.count() == 1000


def test_keys_with_odd_characters_and_file_templates(spark, scratch):
    for key in ("a b", "x+y", "50%", "é"):
        write_files(spark.createDataFrame([(key,)], "v string"), "csv", f"{scratch}/in/{key}", header=True)
    rows = templated_file_reader("csv", f"file://{scratch}/in/{{partition}}", "v string", header=True)(spark, ["a b", "x+y", "é"])
    assert sorted((r.v, r[KEY_COLUMN]) for r in rows.collect()) == [("a b", "a b"), ("x+y", "x+y"), ("é", "é")]
    for key in ("1", "2"):
        with open(f"{scratch}/day-{key}.json", "w") as fh:
            fh.write('{"v": "%s"}\n{"v": \n' % key)
    rows = templated_file_reader("json", f"{scratch}/day-{{partition}}.json", "v string", rescue="bad")(spark, ["1", "2"])
    assert sorted((r[KEY_COLUMN], r.v or "", r.bad) for r in rows.collect()) == [("1", "", '{"v": '), ("1", "1", None), ("2", "", '{"v": '), ("2", "2", None)]


def test_states_merged_equal_a_full_rebuild(spark, scratch):
    """In any order of reloads, with seasons that change, empty or return."""
    rnd = random.Random(8)
    ddl = "season string, who string, team string, points double, pos int, day date"
    season = lambda s: spark.createDataFrame(
        [(s, rnd.choice("abc"), rnd.choice(["x", "y", "z", None]), rnd.choice([1.0, 2.5, None]), rnd.choice([1, 2, None]), None) for _ in range(rnd.choice([0, 3, 20]))], ddl
    )
    table = SliceTable(spark, f"{scratch}/states", "season")
    live = {}
    for step in range(5):
        some = rnd.sample(["1", "2", "3", "4"], 2)
        for s in some:
            live[s] = season(s)
        rows = live[some[0]].union(live[some[1]])
        states.reload(table, states.slice_states(rows, "season", "who", "team", "points", "pos", "day"), some)
        every = season("9").limit(0)
        for df in live.values():
            every = every.union(df)
        want = every.groupBy("who").agg(
            F.count("*").alias("rows"), F.sum("points").alias("total"), F.avg("pos").alias("measure_avg"), F.min("day").alias("first"), F.max("day").alias("last"),
            F.expr("listagg(DISTINCT team, ', ') WITHIN GROUP (ORDER BY team)").alias("all_values"),
        )
        got = states.merged(table.read(), "who", "team")
        modes = {}
        for r in every.where("team IS NOT NULL").groupBy("who", "team").count().collect():
            modes.setdefault(r.who, []).append((-r["count"], r.team))
        assert {r.who: r.most_frequent for r in got.collect()} == {r.who: min(modes.get(r.who, [(0, None)]))[1] for r in want.collect()}
        assert sorted(map(str, got.drop("most_frequent").select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_profile_sample_is_the_same_for_any_split(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, F.lit("x")).alias("s"), F.array("id").alias("a"))
    one = [r.id for r in profile.bottom_k_sample(df.repartition(7), 9).collect()]
    assert one == [r.id for r in profile.bottom_k_sample(df.coalesce(1), 9).collect()] and len(set(one)) == 9
    rows = [tuple(r) for r in profile.column_profile(df).collect()]
    assert rows == [(1, "id", "bigint", 500, 0), (2, "s", "string", 500, 333), (3, "a", "array<bigint>", 500, 0)]
    assert profile.profile(df.limit(0)).columns.count() == 3


def test_exact_distinct(spark):
    rows = [("a", 1), ("a", 1), ("a", 32768), ("a", 32769), ("a", 10**12), ("a", None), ("b", None), ("c", 0), ("c", -5)]
    got = exact_distinct(spark.createDataFrame(rows, "k string, id long"), ["k"], "id", "n")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 4), ("c", 2)]
