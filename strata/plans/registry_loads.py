"""Registered queries for whole records, growing schemas, keyed file sources, reloads, gates and profiles.

Queries that land or version data write under the session's shared work
folder, each call into a fresh path.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import aggs, ordering, profile
from strata.operators.audit import AuditError, Tests
from strata.plans import analogue as A
from strata.plans import build, serve, states
from strata.plans.registry import constructor_mart, driver_mart, register, rounded, with_marts
from strata.session import scratch_path
from strata.sources import catalog, files, growth, ingest, pages
from strata.sources.versioned import SliceTable
from strata.specs import KEY_COLUMN, RECORD_COLUMN, Dataset, SourceSpec

# ------------------------------------------ records as they land (P3, S1, S8), growing schemas

CONTAINER = ["OrderTable", "Orders"]


def _land(records: DataFrame, root: str) -> None:
    """Records (season, page, struct ``r``) as JSON-lines pages under ``root/season=<k>/``."""
    inner = F.struct(F.collect_list("r").alias(CONTAINER[1])).alias(CONTAINER[0])
    envelope = F.struct(F.count("*").cast("string").alias("total"), F.lit("0").alias("offset"), inner)
    grouped = records.groupBy("season", "page").agg(F.to_json(F.struct(envelope.alias("MRData"))).alias("json"))
    grouped.select("season", "json").write.mode("append").partitionBy("season").text(root)


def _orders(spark: SparkSession, sf_dir: str, record: Column) -> DataFrame:
    """Orders as records, a hundred keys to a page."""
    season = A.season_of("o_orderdate").cast("string").alias("season")
    return A.table(spark, sf_dir, "orders").select(season, F.floor(F.col("o_orderkey") / 100).alias("page"), record.alias("r"))


DECLARED = T.StructType([T.StructField("orderkey", T.StringType()), T.StructField("status", T.StringType())])


def _record_source(root: str) -> SourceSpec:
    def read(spark: SparkSession, keys) -> DataFrame:
        return pages.read_pages(spark, root, DECLARED, CONTAINER, keys=keys, multi_line=False, whole=RECORD_COLUMN)

    return SourceSpec("raw_orders", read, partition_column="season")


@register(
    "whole_records",
    """
SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS season, CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus AS status,
       o_custkey AS custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS priority, CAST(o_orderdate AS DATE) AS day
FROM orders""",
)
def q_whole_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that no schema declares are in bronze, read there by path: one nested, one of some records only."""
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )
    root = scratch_path(spark, "landing-whole")
    _land(_orders(spark, sf_dir, record), root)
    spec = _record_source(root)
    bronze = Dataset("orders", (spec,), partitions=tuple(A.seasons_present(spark, sf_dir)), raw_schemas={"raw_orders": T.StructType([*DECLARED.fields, T.StructField(RECORD_COLUMN, T.VariantType())])})
    lake = scratch_path(spark, "lake-whole")
    ingest.load_bronze(spark, bronze, root=lake)
    rows = ingest.read_bronze(spark, bronze, lake)["raw_orders"]
    path = lambda p, kind: F.variant_get(RECORD_COLUMN, p, kind)
    return rows.select("season", "orderkey", "status", path("$.customer.key", "bigint").alias("custkey"), path("$.priority", "string").alias("priority"), path("$.day", "date").alias("day"))


@register(
    "grown_records",
    """
SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS season, CASE WHEN year(o_orderdate) > 1994 THEN 'K' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS orderkey,
       o_orderstatus AS status, CAST(o_custkey AS DOUBLE) + CASE WHEN year(o_orderdate) > 1994 THEN 0.5 ELSE 0 END AS amount,
       CASE WHEN year(o_orderdate) > 1994 THEN o_orderpriority END AS priority, CAST(o_custkey AS VARCHAR) AS customer_key,
       CASE WHEN year(o_orderdate) > 1994 THEN o_orderstatus END AS customer_status
FROM orders""",
)
def q_grown_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings: the second has new fields, also in a struct, a key that became text, and fractions."""
    late = A.season_of("o_orderdate") > 1994
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    first = F.struct(key.alias("orderkey"), F.col("o_orderstatus").alias("status"), cust.alias("amount"), F.struct(cust.alias("key")).alias("customer"))
    second = F.struct(
        F.concat(F.lit("K"), key.cast("string")).alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
        (cust + 0.5).alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.struct(cust.cast("string").alias("key"), F.col("o_orderstatus").alias("status")).alias("customer"),
    )
    table = SliceTable(spark, scratch_path(spark, "bronze-grown"), "season")
    for record, which in ((first, ~late), (second, late)):
        root = scratch_path(spark, "landing-grown")
        season = A.season_of("o_orderdate").cast("string").alias("season")
        rows = A.table(spark, sf_dir, "orders").where(which).select(season, F.floor(key / 100).alias("page"), record.alias("r"))
        _land(rows, root)
        landed = pages.read_pages(spark, root, T.StructType([DECLARED["status"]]), CONTAINER, multi_line=False, whole=RECORD_COLUMN)
        table.load(landed.withColumn("season", F.col(KEY_COLUMN)).drop(KEY_COLUMN, pages.PAGE_OFFSET))
    grown = growth.read_grown(table)
    return grown.select("season", "orderkey", "status", F.col("amount").cast("double").alias("amount"), "priority", F.col("customer.key").alias("customer_key"), F.col("customer.status").alias("customer_status"))


# ---------------------------------------------------------------- gaps in landed pages (S3)


@register(
    "missing_page_ranges",
    """
WITH landed AS (SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS key, o_orderkey AS page FROM orders),
ends AS (SELECT key, page FROM landed UNION ALL SELECT key, -1 FROM landed GROUP BY key
         UNION ALL SELECT DISTINCT key, (SELECT max(page) + 11 FROM landed) FROM landed),
pairs AS (SELECT key, lag(page) OVER (PARTITION BY key ORDER BY page) + 1 AS lo, page - 1 AS hi FROM ends)
SELECT key, CAST(lo * 30 AS BIGINT) AS first_offset, CAST(hi * 30 AS BIGINT) AS last_offset, CAST(hi - lo + 1 AS BIGINT) AS n_pages
FROM pairs WHERE lo <= hi""",
)
def q_missing_page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders taken as pages of their season, numbered by order key: what of the whole range each season lacks."""
    orders = A.table(spark, sf_dir, "orders")
    total = orders.agg(((F.max("o_orderkey") + 11) * 30).alias("total"))
    landed = orders.select(A.season_of("o_orderdate").cast("string").alias("key"), (F.col("o_orderkey") * 30).alias("offset"))
    inventory = landed.withColumn("total", total.scalar())
    return pages.missing_ranges(inventory, 30)


# ------------------------------------------------------- one scan for many keys

KEYED_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
KEYED_SQL = """
SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS season, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders"""


def _keyed(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Orders written to a folder for each season and read back through one templated scan."""
    root = scratch_path(spark, f"keyed-{fmt}")
    orders = A.table(spark, sf_dir, "orders").withColumn("y", A.season_of("o_orderdate"))
    writer = orders.select("y", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority").write.partitionBy("y").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(root)
    options = {"header": True} if fmt == "csv" else {}
    read = files.templated_file_reader(fmt, f"{root}/y={{partition}}", KEYED_SCHEMA, **options)
    rows = read(spark, A.seasons_present(spark, sf_dir))
    return rows.select(F.col(KEY_COLUMN).alias("season"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


for _fmt in ("csv", "json", "parquet"):
    register(f"keyed_files_{_fmt}", KEYED_SQL)(partial(_keyed, fmt=_fmt))


@register(
    "rescued_rows",
    """
SELECT CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) AS season, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS orderkey,
       CASE WHEN o_orderkey % 7 = 0 THEN '{"orderkey":' || CAST(o_orderkey AS VARCHAR) || ',broken' END AS unparsed
FROM orders""",
)
def q_rescued_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which every seventh is cut off: its text is kept."""
    root = scratch_path(spark, "keyed-rescue")
    key = F.concat(F.lit('{"orderkey":'), F.col("o_orderkey").cast("string"))
    line = F.when(F.col("o_orderkey") % 7 == 0, F.concat(key, F.lit(",broken"))).otherwise(F.concat(key, F.lit("}")))
    A.table(spark, sf_dir, "orders").select(A.season_of("o_orderdate").alias("y"), line.alias("value")).write.partitionBy("y").text(root)
    read = files.templated_file_reader("json", f"{root}/y={{partition}}", "orderkey bigint", rescue="unparsed")
    rows = read(spark, A.seasons_present(spark, sf_dir))
    fits = F.col("unparsed").isNull()
    return rows.select(F.col(KEY_COLUMN).alias("season"), F.when(fits, F.col("orderkey")).alias("orderkey"), "unparsed")


# ------------------------------------------------------------ every season at once (Q13)


@register(
    "top10_drivers_by_season",
    with_marts(
        """
SELECT season, driver_id, driver_name, primary_constructor, total_points, wins, podiums,
       CAST(row_number() OVER (PARTITION BY season ORDER BY total_points DESC NULLS LAST, driver_id) AS INTEGER) AS place
FROM mart_driver_standings QUALIFY place <= 10"""
    ),
)
def q_top10_drivers_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = serve.best_of_every_season(driver_mart(spark, sf_dir), 10)
    return best.select("season", "driver_id", "driver_name", "primary_constructor", "total_points", "wins", "podiums", "place")


@register(
    "top10_constructors_by_season",
    with_marts(
        """
SELECT season, constructor_name, total_points, races_entered,
       CAST(row_number() OVER (PARTITION BY season ORDER BY total_points DESC NULLS LAST, constructor_name) AS INTEGER) AS place
FROM mart_constructor_standings QUALIFY place <= 10"""
    ),
)
def q_top10_constructors_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = serve.best_of_every_season(constructor_mart(spark, sf_dir), 10, "constructor_name")
    return best.select("season", "constructor_name", "total_points", "races_entered", "place")


# ----------------------------------------------- reload of some keys (S10), rebuilds (S9, S17), SQL


@register(
    "reloaded_driver_totals",
    """
WITH r AS (SELECT o.o_custkey AS driver_id, 'S' || l.l_suppkey AS team, l.l_quantity AS points, CASE WHEN l.l_returnflag <> 'R' THEN l.l_partkey % 20 + 1 END AS pos, CAST(o.o_orderdate AS DATE) AS day
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
counts AS (SELECT driver_id, team, count(*) AS n FROM r GROUP BY ALL),
home AS (SELECT driver_id, first(team ORDER BY n DESC, team) AS most_frequent, string_agg(team, ', ' ORDER BY team) AS all_values FROM counts GROUP BY driver_id)
SELECT driver_id, count(*) AS "rows", sum(points) AS total, round(avg(pos), 6) AS measure_avg, min(day) AS "first", max(day) AS "last",
       any_value(most_frequent) AS most_frequent, any_value(all_values) AS all_values
FROM r JOIN home USING (driver_id) GROUP BY driver_id""",
)
def q_reloaded_driver_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all seasons from states by season: loaded with one season's lines missing, then two seasons again."""
    lines, orders = A.table(spark, sf_dir, "lineitem"), A.table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        A.season_of("o_orderdate").cast("string").alias("season"),
        F.col("o_custkey").alias("driver_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("team"),
        F.col("l_quantity").alias("points"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey") % 20 + 1).alias("pos"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    of = lambda r: states.slice_states(r, "season", "driver_id", "team", "points", "pos", "day")
    seasons = A.seasons_present(spark, sf_dir)
    table = SliceTable(spark, scratch_path(spark, "driver-states"), "season")
    states.reload(table, of(rows.where((F.col("season") != seasons[-1]) | (F.col("points") > 10))), seasons)
    states.reload(table, of(rows), [seasons[-1], seasons[0]])
    return rounded(states.merged(table.read(), "driver_id", "team"), "measure_avg")


@register("bronze_overwrite", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 20")
def q_bronze_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without slices: the second load replaces all rows of the first."""
    part = A.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    table = SliceTable(spark, scratch_path(spark, "bronze-part"), None)
    table.load(part)
    table.load(part.where("p_size > 20"))
    return table.read(schema=part.schema)


@register("materialised_model", with_marts("SELECT * EXCLUDE avg_finishing_position FROM mart_constructor_standings"))
def q_materialised_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written as Parquet over an older one, by season, and read back."""
    path = scratch_path(spark, "mart-files")
    mart = constructor_mart(spark, sf_dir).drop("avg_finishing_position")
    catalog.materialise(mart.where("season < 1995"), path, partition_by=("season",))
    catalog.materialise(mart, path, partition_by=("season",))
    return catalog.read_model(spark, path).select(*mart.columns)


@register(
    "bronze_sql",
    """
WITH e AS (SELECT *, day(ts) AS v FROM events WHERE day(ts) <= 15),
last AS (SELECT event_type, max(v) AS v FROM e GROUP BY event_type)
SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users, max(event_id) AS last_event
FROM e JOIN last USING (event_type, v) WHERE event_type IN ('error', 'click') GROUP BY event_type""",
)
def q_bronze_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices as of version 15, each through the table function in SQL."""
    events = A.table(spark, sf_dir, "events").withColumn("version", F.dayofmonth("ts").cast("long"))
    table = SliceTable(spark, scratch_path(spark, "bronze-sql"), "event_type")
    table.create()
    table.load_versions(events, "version")
    catalog.register_function(spark, "events_at", table, events.schema)
    one = "SELECT event_type, count(*) AS n, sum(user_id) AS users, max(event_id) AS last_event FROM events_at('{}', 15) GROUP BY event_type"
    return spark.sql(" UNION ALL ".join(one.format(s) for s in ("error", "click")))


@register("head_orders", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """head() of the orders by key."""
    return ordering.head(A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey"))


# ----------------------------------------------------------- tests gate a build

GATE = Tests(unique=("constructor_season_key",), not_null=("constructor_season_key", "season", "constructor_name"))


@register(
    "gated_publish",
    with_marts(
        """
m AS (SELECT season = 1997 AS odd FROM mart_constructor_standings),
found(test, failures) AS (
    SELECT 'unique_constructor_season_key', count(*) FILTER (NOT odd) FROM m
    UNION ALL SELECT 'not_null_constructor_season_key', 2 * count(*) FILTER (odd) FROM m
    UNION ALL SELECT 'not_null_season', 0 UNION ALL SELECT 'not_null_constructor_name', 0)
SELECT test, failures::BIGINT AS failures, (SELECT count(*) FROM m) AS rows_visible, 0::BIGINT AS version FROM found WHERE failures > 0"""
    ),
)
def q_gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart is published, then one with repeated and missing keys is refused: its failing tests, and what readers see."""
    mart = constructor_mart(spark, sf_dir)
    path = scratch_path(spark, "gated")
    table, _ = build.publish_version(mart, GATE, path)
    broken = mart.withColumn("constructor_season_key", F.when(F.col("season") != 1997, F.col("constructor_season_key")))
    failures: dict[str, int] = {}
    try:
        build.publish_version(broken.union(broken), GATE, path)
    except AuditError as e:
        failures = e.failures
    rows = spark.createDataFrame(sorted(failures.items()), "test string, failures long")
    seen = table.read().agg(F.count("*").alias("n"))
    return rows.withColumn("rows_visible", seen.scalar()).withColumn("version", F.lit(table.version()).cast("long"))


# ------------------------------------------------------------------- profile (Q9)

PROFILED = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = A.table(spark, sf_dir, "documents"), A.table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(*PROFILED)


@register(
    "profile_columns",
    "WITH d AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))\n"
    + "\nUNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count FROM d"
        for i, (c, kind) in enumerate(zip(PROFILED, ("bigint", "string", "string", "bigint", "int", "int"), strict=True))
    ),
)
def q_profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema, row count and NULL counts of documents with their labels."""
    return profile.profile(_profiled(spark, sf_dir)).columns


@register(
    "profile_sample",
    """
SELECT doc_id, lang, source, n_chars, quality, toxic,
       md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(1)), coalesce(lang, chr(1)), coalesce(source, chr(1)), coalesce(n_chars::VARCHAR, chr(1)),
                     coalesce(quality::VARCHAR, chr(1)), coalesce(toxic::VARCHAR, chr(1)))) AS row_digest
FROM documents LEFT JOIN labels USING (doc_id) ORDER BY row_digest LIMIT 20""",
)
def q_profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty rows that any split of the table gives."""
    return profile.bottom_k_sample(_profiled(spark, sf_dir), 20)


# ------------------------------------------- driver counts and 1-2 finishes


@register(
    "constructor_lineups",
    """
WITH r AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, l_suppkey AS constructor_id, o_custkey AS driver_id, o_orderkey AS race,
                  CASE WHEN l_returnflag <> 'R' THEN l_partkey % 20 + 1 END AS pos
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
races AS (SELECT season, constructor_id, race, count(*) FILTER (pos <= 2) AS front FROM r GROUP BY ALL)
SELECT season, constructor_id, (SELECT count(DISTINCT driver_id) FROM r WHERE r.season = races.season AND r.constructor_id = races.constructor_id) AS drivers,
       count(*) FILTER (front >= 2) AS one_two_finishes
FROM races GROUP BY season, constructor_id""",
)
def q_constructor_lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers of each constructor and season, exactly, and races with two cars in the first two places."""
    lines, orders = A.table(spark, sf_dir, "lineitem"), A.table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        A.season_of("o_orderdate").alias("season"),
        F.col("l_suppkey").alias("constructor_id"),
        F.col("o_custkey").alias("driver_id"),
        F.col("o_orderkey").alias("race"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey") % 20 + 1).alias("pos"),
    )
    keys = ["season", "constructor_id"]
    drivers = aggs.exact_distinct(rows, keys, "driver_id", "drivers")
    by_race = rows.groupBy(*keys, "race").agg(F.count_if(F.col("pos") <= 2).alias("front"))
    front = by_race.groupBy(*keys).agg(F.count_if(F.col("front") >= 2).alias("one_two_finishes"))
    return drivers.join(front, keys)


