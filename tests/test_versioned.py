"""Versioned slice tables: isolation, growth, emptying, as-of, invisibility, clashes."""

import pytest
from pyspark.sql import functions as F

from strata.sources.versioned import SliceTable


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def frame(spark, data, ddl="id int, name string"):
    return spark.createDataFrame(data, ddl)


def test_slice_isolation_as_of_and_history(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    assert t.version() == -1 and t.read().count() == 0
    v0 = t.load_slice(frame(spark, [(1, "a"), (2, "b")]), "2023")
    v1 = t.load_slice(frame(spark, [(3, "c"), (4, "d"), (5, "e")]), "2024")
    v2 = t.load_slice(frame(spark, [(3, "c"), (4, "d")]), "2024")  # one row fewer
    assert (v0, v1, v2) == (0, 1, 2) and t.version() == 2
    cur = t.read()
    assert rows(cur, "season", "id") == [("2023", 1), ("2023", 2), ("2024", 3), ("2024", 4)]
    assert dict(cur.dtypes)["season"] == "string"
    assert rows(t.read(version=1), "season", "id") == [
        ("2023", 1), ("2023", 2), ("2024", 3), ("2024", 4), ("2024", 5)
    ]
    assert rows(t.read(version=0), "season", "id") == [("2023", 1), ("2023", 2)]
    hist = rows(t.history(), "version", "slice", "row_count", "operation")
    assert hist == [(0, "2023", 2, "WRITE"), (1, "2024", 3, "WRITE"), (2, "2024", 2, "WRITE")]


def test_empty_reload_empties_only_its_slice(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    t.load_slice(frame(spark, [(2, "b")]), "2024")
    t.load_slice(frame(spark, []), "2024")
    assert rows(t.read(), "season", "id") == [("2023", 1)]
    assert rows(t.read(version=1), "season", "id") == [("2023", 1), ("2024", 2)]


def test_stamp_overrides_source_column(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    df = spark.createDataFrame([(1, "9999")], "id int, season string")
    t.load_slice(df, "2023")
    assert rows(t.read(), "season", "id") == [("2023", 1)]


def test_schema_growth_merges_and_declared_schema(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    grown = spark.createDataFrame([(2, "b", ("q1",))], "id int, name string, extra struct<round:string>")
    t.load_slice(grown, "2024")
    merged = t.read()
    assert set(merged.columns) == {"id", "name", "extra", "season"}
    got = {r["season"]: r["extra"] for r in merged.collect()}
    assert got["2023"] is None and got["2024"]["round"] == "q1"
    declared = t.read(schema=grown.schema)
    assert {r["season"]: r["extra"] for r in declared.collect()} == got


def test_uncommitted_batch_is_invisible(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    # a crashed load: rows written, no commit
    t._write(t.stamp(frame(spark, [(7, "zz")]), "2023"), F.lit("crashed"))
    t._write(t.stamp(frame(spark, [(8, "zz")]), "2025"), F.lit("crashed"))
    assert rows(t.read(), "season", "id") == [("2023", 1)]


def test_commit_clash_is_refused(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    late = SliceTable(spark, f"{scratch}/t", "season")
    late.version = lambda: -1  # read before the first load came to its end
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        late.load_slice(frame(spark, [(2, "b")]), "2023")
    assert rows(t.read(), "season", "id") == [("2023", 1)]


def test_multi_key_load_with_empty_key(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load(spark.createDataFrame([(1, "2023"), (2, "2024")], "id int, season string"), ["2023", "2024"])
    v = t.load(spark.createDataFrame([(3, "2023")], "id int, season string"), ["2023", "2024"])
    assert v == 1
    assert rows(t.read(), "season", "id") == [("2023", 3)]
    hist = rows(t.history().filter("version = 1"), "slice", "row_count")
    assert hist == [("2023", 1), ("2024", 0)]
    with pytest.raises(Exception, match="outside the load's keys"):
        t.load(spark.createDataFrame([(4, "2030")], "id int, season string"), ["2023"])
    assert rows(t.read(), "season", "id") == [("2023", 3)]


def test_unpartitioned_table_replaces_whole(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", None)
    t.load(frame(spark, [(1, "a"), (2, "b")]))
    t.load(frame(spark, [(3, "c")]))
    assert rows(t.read(), "id") == [(3,)]
    assert rows(t.read(version=0), "id") == [(1,), (2,)]
    assert "season" not in t.read().columns


def test_load_versions_replays_history(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "kind")
    assert t.create() == 0 and t.read().count() == 0
    df = spark.createDataFrame(
        [(1, "a", 1), (2, "b", 1), (3, "a", 2), (4, "a", 3), (5, "b", 3)],
        "id int, kind string, version long",
    )
    assert t.load_versions(df, "version") == [1, 2, 3]
    assert rows(t.read(version=1), "kind", "id") == [("a", 1), ("b", 2)]
    assert rows(t.read(version=2), "kind", "id") == [("a", 3), ("b", 2)]
    assert rows(t.read(), "kind", "id") == [("a", 4), ("b", 5)]
    assert t.version() == 3
    fresh = SliceTable(spark, f"{scratch}/t", "kind")  # no remembered version
    assert fresh.version() == 3
    assert rows(fresh.history(), "version", "slice", "row_count") == [
        (1, "a", 1), (1, "b", 1), (2, "a", 1), (3, "a", 1), (3, "b", 1)
    ]
    with pytest.raises(ValueError):  # versions must continue the table
        t.load_versions(df.withColumn("version", F.col("version") + 10), "version")
    assert t.version() == 3


def test_version_search_over_many_commits(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "k")
    t.create()
    df = spark.range(1, 41).select(F.col("id").alias("version"), (F.col("id") % 3).cast("string").alias("k"))
    t.load_versions(df, "version")
    assert SliceTable(spark, f"{scratch}/t", "k").version() == 40
    assert rows(t.read(version=17), "k", "version") == [("0", 15), ("1", 16), ("2", 17)]


def test_partition_values_with_special_characters(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "k")
    for key in ["a/b", "x=y", "50%", "sp ace"]:
        t.load_slice(frame(spark, [(1, key)]), key)
    assert rows(t.read(), "k") == [("50%",), ("a/b",), ("sp ace",), ("x=y",)]
    assert rows(t.read(slices=["50%", "a/b"]), "k") == [("50%",), ("a/b",)]


def test_one_slice_read_prunes(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    t.load_slice(frame(spark, [(2, "b")]), "2024")
    df = t.read(slices=["2024"])
    assert rows(df, "season", "id") == [("2024", 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "2023" not in plan


def test_publish_version_is_full_and_atomic(spark, scratch):
    from strata.operators.audit import AuditError, Tests
    from strata.plans.build import publish_version

    tests = Tests(unique=("k",), not_null=("k",))
    first = spark.createDataFrame([(2023, "a", 1.0), (2024, "b", 2.0)], "season int, k string, v double")
    table, v0 = publish_version(first, tests, f"{scratch}/mart")
    second = spark.createDataFrame([(2024, "c", 3.0)], "season int, k string, v double")
    publish_version(second, tests, f"{scratch}/mart")
    assert rows(table.read(), "season", "k") == [(2024, "c")]  # 2023 vanished → emptied
    assert dict(table.read().dtypes)["season"] == "int"
    bad = spark.createDataFrame([(2024, "d", 1.0), (2024, "d", 2.0)], "season int, k string, v double")
    with pytest.raises(AuditError):
        publish_version(bad, tests, f"{scratch}/mart")
    assert rows(table.read(), "season", "k") == [(2024, "c")]
    assert rows(table.read(version=v0), "season", "k") == [(2023, "a"), (2024, "b")]


def test_stage_is_invisible_until_commit_and_spread_bounds_files(spark, scratch):
    import glob

    t = SliceTable(spark, f"{scratch}/t", "season")
    df = spark.range(3000).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise((F.col("id") % 3).cast("string")).alias("season"),
    ).repartition(8)
    staged = t.stage(df, files_per_slice=2)
    assert t.read().count() == 0 and t.read_staged(staged).count() == 3000
    t.commit(staged)
    assert t.read().count() == 3000 and t.read(slices=["hot"]).count() == 1000
    hot_files = glob.glob(f"{scratch}/t/data/season=hot/batch_id={staged.token}/*.parquet")
    assert 1 <= len(hot_files) <= 2


def test_superseded_lists_replaced_and_crashed(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    t.load_slice(frame(spark, [(2, "b")]), "2024")
    t.load_slice(frame(spark, [(3, "c")]), "2024")  # replaces the first 2024 batch
    t._write(t.stamp(frame(spark, [(9, "z")]), "2025"), F.lit("crashed"))  # never committed
    first_2024 = [r["batch_id"] for r in t.live(1).collect() if r["slice"] == "2024"][0]
    assert rows(t.superseded(), "slice", "batch_id") == [("2024", first_2024), ("2025", "crashed")]
    assert rows(t.superseded(keep_versions=3), "slice", "batch_id") == [("2025", "crashed")]
    assert rows(t.read(), "season", "id") == [("2023", 1), ("2024", 3)]


def test_a_load_in_flight_is_never_written_into(spark, scratch):
    import os

    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    os.makedirs(f"{scratch}/t/loads/version=1/_temporary/0")  # another writer's, or a crashed one's
    assert SliceTable(spark, f"{scratch}/t", "season").version() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        t.load_slice(frame(spark, [(2, "b")]), "2024")
    assert rows(t.read(), "season", "id") == [("2023", 1)]


def test_unknown_versions_are_refused(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    for version in (1, 99, -5):
        with pytest.raises(ValueError, match="no version"):
            t.read(version=version)


def test_a_second_history_writer_goes_nowhere(spark, scratch):
    one, two = (SliceTable(spark, f"{scratch}/t", "season") for _ in range(2))
    events = spark.createDataFrame([(1, "2023", 0), (2, "2023", 1)], "id int, season string, n int")
    two.version = lambda: -1  # read before the first one commits
    one.load_versions(events, "n")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        two.load_versions(events, "n")
    fresh = SliceTable(spark, f"{scratch}/t", "season")
    assert rows(fresh.read(version=0), "season", "id") == [("2023", 1)]
    assert rows(fresh.read(), "season", "id") == [("2023", 2)]


def test_a_hot_slice_is_written_by_as_many_tasks_as_its_size_asks_for(spark, scratch):
    from pyspark.sql import functions as F

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        t = SliceTable(spark, f"{scratch}/t", "season")
        df = spark.range(60_000).select("id", F.lit("2024").alias("season"), F.md5(F.col("id").cast("string")).alias("x"))
        t.load_slice(df, "2024")
        assert len(t.read().inputFiles()) > 2
    finally:
        spark.conf.unset(key)


def test_a_null_slice_and_a_column_that_no_live_slice_has(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "k")
    t.load(spark.createDataFrame([(1, None, "x"), (2, "a", "y")], "id int, k string, extra string"))
    t.load(spark.createDataFrame([(3, None), (4, "a")], "id int, k string"))
    assert sorted((r.id, r.k, r.extra) for r in t.read().collect()) == [(3, None, None), (4, "a", None)]
    assert sorted((r.id, r.extra) for r in t.read(version=0).collect()) == [(1, "x"), (2, "y")]


def test_a_first_load_without_rows(spark, scratch):
    t = SliceTable(spark, f"{scratch}/t", "season")
    assert t.load_slice(frame(spark, []), "2023") == 0 and t.read().count() == 0
    t.load_slice(frame(spark, [(1, "a")]), "2023")
    assert rows(t.read(), "season", "id") == [("2023", 1)]


def test_the_write_counts_nulls_and_keys_share_one_pass(spark, scratch):
    from strata.operators.audit import AuditError, Tests, duplicate_counts
    from strata.plans.build import publish_version

    df = spark.createDataFrame([(2023, "a", 1), (2023, "a", 1), (2024, None, 2), (2024, "c", None)], "season int, k string, n int")
    assert duplicate_counts(df, ["k", "n", "season"]) == {"unique_k": 1, "unique_n": 1, "unique_season": 2}
    with pytest.raises(AuditError) as err:
        publish_version(df, Tests(unique=("k", "n"), not_null=("k", "n", "season")), f"{scratch}/mart")
    assert err.value.failures == {"unique_k": 1, "unique_n": 1, "not_null_k": 1, "not_null_n": 1}
    assert SliceTable(spark, f"{scratch}/mart", "season", "int").version() == -1  # nothing is visible
