"""Silver tables with F1 roles, derived from the TPC-H-like test tables.

Mapping (the same on the Spark side and in the DuckDB oracle):

* season: ``year(o_orderdate)`` as int; race: one order; round: day of year
* result row: ``lineitem ⋈ orders ⋈ supplier`` with ``l_linestatus = 'F'``;
  sprint row: the same with ``'O'``
* driver: ``o_custkey`` with name ``c_name`` and nationality ``c_mktsegment``;
  drivers are listed per season in which they have an order
* constructor: ``s_name``; points: ``l_quantity``
* grid position: ``l_orderkey % 20 + 1``; finishing position:
  ``l_partkey % 20 + 1``, NULL when ``l_returnflag = 'R'`` (a retirement)
* circuit: ``o_orderpriority``; country: the customer's ``n_name``;
  latitude / longitude: ``n_nationkey`` / ``n_regionkey``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import in_year

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def season_of(ts_col: str) -> F.Column:
    return F.year(ts_col).cast("int")


def season_orders(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    """``orders``, of one season where it is given: a date range that the scan skips row groups by."""
    orders = table(spark, sf_dir, "orders")
    return orders if season is None else orders.where(in_year(orders, "o_orderdate", season))


def _result_rows(spark: SparkSession, sf_dir: str, linestatus: str, named: bool = True) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == linestatus)
    orders = table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    team = [F.col("l_suppkey").alias("constructor_id")]
    if named:
        suppliers = table(spark, sf_dir, "supplier")
        joined = joined.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        team.append(F.col("s_name").alias("constructor_name"))
    return joined.select(
        season_of("o_orderdate").alias("season"),
        F.dayofyear("o_orderdate").alias("round"),
        F.col("o_custkey").alias("driver_id"),
        *team,
        F.col("l_quantity").alias("points"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("int"))
        .otherwise((F.col("l_partkey") % 20 + 1).cast("int"))
        .alias("finishing_position"),
        (F.col("l_orderkey") % 20 + 1).cast("int").alias("grid_position"),
    )


def results(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    """Grand Prix result rows (stg_results roles); without ``named`` no team names, and no join for them."""
    return _result_rows(spark, sf_dir, "F", named)


def sprint_results(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    """Sprint result rows (stg_sprint_results roles)."""
    return _result_rows(spark, sf_dir, "O", named)


def tagged_result_rows(spark: SparkSession, sf_dir: str, named: bool = True, season: int | None = None) -> DataFrame:
    """Grand Prix and sprint rows from one scan, flagged ``_is_sprint``.

    The same rows as ``results`` ∪ ``sprint_results``, but ``lineitem`` and its
    join with ``orders`` are read once for both kinds.
    """
    from strata.plans.marts import SPRINT_FLAG

    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus").isin("F", "O"))
    orders = season_orders(spark, sf_dir, season)
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    team = [F.col("l_suppkey").alias("constructor_id")]
    if named:
        suppliers = table(spark, sf_dir, "supplier")
        joined = joined.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        team.append(F.col("s_name").alias("constructor_name"))
    return joined.select(
        season_of("o_orderdate").alias("season"),
        F.col("o_custkey").alias("driver_id"),
        *team,
        F.col("l_quantity").alias("points"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("int"))
        .otherwise((F.col("l_partkey") % 20 + 1).cast("int"))
        .alias("finishing_position"),
        (F.col("l_orderkey") % 20 + 1).cast("int").alias("grid_position"),
        (F.col("l_linestatus") == "O").alias(SPRINT_FLAG),
    )


def team_names(spark: SparkSession, sf_dir: str):
    """Team id → name lookup (``supplier``)."""
    from strata.plans.marts import NameLookup

    return NameLookup(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name")


def drivers(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    """One row per (season, driver) with an order that season (stg_drivers roles)."""
    orders = season_orders(spark, sf_dir, season)
    customers = table(spark, sf_dir, "customer")
    seasons = orders.select(
        season_of("o_orderdate").alias("season"), F.col("o_custkey").alias("driver_id")
    ).distinct()
    joined = seasons.join(customers, seasons.driver_id == customers.c_custkey)
    return joined.select(
        "season",
        "driver_id",
        F.col("c_name").alias("full_name"),
        F.lit(None).cast("string").alias("driver_code"),
        F.col("c_mktsegment").alias("nationality"),
        F.lit(None).cast("date").alias("date_of_birth"),
    )


def race_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``races`` that an order holds itself."""
    return table(spark, sf_dir, "orders").select(
        season_of("o_orderdate").alias("season"),
        F.dayofyear("o_orderdate").alias("round"),
        F.col("o_orderdate").cast("date").alias("race_date"),
        F.col("o_orderkey").cast("string").alias("race_name"),
    )


def races(spark: SparkSession, sf_dir: str, season: int | None = None) -> DataFrame:
    """One row per order (stg_races roles)."""
    orders = season_orders(spark, sf_dir, season)
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return joined.select(
        season_of("o_orderdate").alias("season"),
        F.dayofyear("o_orderdate").alias("round"),
        F.col("o_orderdate").cast("date").alias("race_date"),
        F.col("o_orderkey").cast("string").alias("race_name"),
        F.col("o_orderpriority").alias("circuit_name"),
        F.col("n_name").alias("circuit_country"),
        F.col("n_nationkey").cast("double").alias("circuit_lat"),
        F.col("n_regionkey").cast("double").alias("circuit_long"),
    )


# DuckDB text of the same derivations, used as CTEs by the oracle queries.
ORACLE_SILVER = """
stg_results AS (
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season,
           CAST(dayofyear(o.o_orderdate) AS INTEGER) AS round,
           o.o_custkey AS driver_id,
           s.s_suppkey AS constructor_id,
           s.s_name AS constructor_name,
           l.l_quantity AS points,
           CASE WHEN l.l_returnflag = 'R' THEN NULL
                ELSE CAST(l.l_partkey % 20 + 1 AS INTEGER) END AS finishing_position,
           CAST(l.l_orderkey % 20 + 1 AS INTEGER) AS grid_position
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    WHERE l.l_linestatus = 'F'
),
stg_sprint_results AS (
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season,
           CAST(dayofyear(o.o_orderdate) AS INTEGER) AS round,
           o.o_custkey AS driver_id,
           s.s_suppkey AS constructor_id,
           s.s_name AS constructor_name,
           l.l_quantity AS points,
           CASE WHEN l.l_returnflag = 'R' THEN NULL
                ELSE CAST(l.l_partkey % 20 + 1 AS INTEGER) END AS finishing_position,
           CAST(l.l_orderkey % 20 + 1 AS INTEGER) AS grid_position
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    WHERE l.l_linestatus = 'O'
),
stg_drivers AS (
    SELECT d.season, d.driver_id, c.c_name AS full_name,
           CAST(NULL AS VARCHAR) AS driver_code,
           c.c_mktsegment AS nationality,
           CAST(NULL AS DATE) AS date_of_birth
    FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey AS driver_id
          FROM orders) d
    JOIN customer c ON d.driver_id = c.c_custkey
),
stg_races AS (
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season,
           CAST(dayofyear(o.o_orderdate) AS INTEGER) AS round,
           CAST(o.o_orderdate AS DATE) AS race_date,
           CAST(o.o_orderkey AS VARCHAR) AS race_name,
           o.o_orderpriority AS circuit_name,
           n.n_name AS circuit_country,
           CAST(n.n_nationkey AS DOUBLE) AS circuit_lat,
           CAST(n.n_regionkey AS DOUBLE) AS circuit_long
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


# ------------------------------------------------- bronze-shaped derivations
# Inputs in the shape the source system lands (strings, nested structs, pages),
# derived from the test tables so the ingest and staging code runs on them.


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


LINE_FIELDS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_returnflag", "l_linestatus", "l_shipdate", "o_custkey",
)


def result_record(get) -> F.Column:
    """The string-typed API result record of one line; ``get(name)`` reads a field.

    ``get`` is ``F.col`` for flat rows, or a struct accessor inside
    ``F.transform`` so records are built after a shuffle of raw columns.
    """
    position = F.when(get("l_returnflag") == "R", F.lit("R")).otherwise(_s(get("l_partkey") % 20 + 1))
    return F.struct(
        _s(F.year(get("l_shipdate"))).alias("season"),
        F.when(get("l_returnflag") == "A", F.lit("")).otherwise(_s(get("l_linenumber"))).alias("number"),
        position.alias("position"),
        _s(get("l_quantity").cast("bigint")).alias("points"),
        _s(get("l_orderkey") % 20 + 1).alias("grid"),
        _s(get("l_linenumber") * 10).alias("laps"),
        get("l_returnflag").alias("status"),
        F.struct(_s(get("o_custkey")).alias("driverId")).alias("Driver"),
        F.struct(
            _s(get("l_suppkey")).alias("constructorId"),
            F.concat(F.lit("S"), _s(get("l_suppkey"))).alias("name"),
        ).alias("Constructor"),
        F.when(
            get("l_linestatus") == "F",
            F.struct(_s(get("l_orderkey") * 1000 + get("l_linenumber")).alias("millis")),
        ).alias("Time"),
        F.when(
            get("l_returnflag") != "N",
            F.struct(
                _s(get("l_partkey") % 20 + 1).alias("rank"),
                F.when(get("l_linenumber") > 5, F.lit("x")).otherwise(_s(get("l_linenumber"))).alias("lap"),
            ),
        ).alias("FastestLap"),
    )


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _parent_fields() -> list[F.Column]:
    return [
        _s(season_of("o_orderdate")).alias("parent_season"),
        _s(F.dayofyear("o_orderdate")).alias("parent_round"),
        _s("o_orderkey").alias("parent_race"),
    ]


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order, as string-typed API-style result records."""
    return _raw_lines(spark, sf_dir).select(
        "o_orderkey", "l_linenumber", "l_linestatus", *_parent_fields(), result_record(F.col).alias("result")
    )


def nested_results(spark: SparkSession, sf_dir: str, array_key: str, linestatus: str | None = None) -> DataFrame:
    """Parent records per (order, line number) with their result records nested.

    The raw line columns are grouped (a partial-aggregated shuffle of numbers),
    and the string records are built per array afterwards with ``transform``.
    """
    raw = _raw_lines(spark, sf_dir)
    if linestatus is not None:
        raw = raw.filter(F.col("l_linestatus") == linestatus)
    keys = ["o_orderkey", "l_linenumber", "o_orderdate"]  # all of them: a hot order's lines go to many tasks
    grouped = raw.repartition(*keys).groupBy(*keys).agg(
        F.collect_list(F.struct(*LINE_FIELDS)).alias("_lines")
    )
    return grouped.select(
        "o_orderkey",
        "l_linenumber",
        *_parent_fields(),
        F.transform("_lines", lambda x: result_record(lambda n: x[n])).alias(array_key),
    )


def nested_order_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per parent record: an order's lines nested under ``Results``.

    Lines are grouped per (order, line number), so one order can appear as
    several parents (like a race split over pages); orders without lines give
    a parent without a ``Results`` key.
    """
    parents = nested_results(spark, sf_dir, "Results")
    orders = table(spark, sf_dir, "orders")
    bare = orders.join(
        table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")),
        "o_orderkey",
        "left_anti",
    ).select(
        _s(season_of("o_orderdate")).alias("parent_season"),
        _s(F.dayofyear("o_orderdate")).alias("parent_round"),
        _s("o_orderkey").alias("parent_race"),
        F.lit(None).alias("Results"),
    )
    shaped = parents.select("parent_season", "parent_round", "parent_race", "Results").unionByName(
        bare, allowMissingColumns=True
    )
    doc = F.struct(
        F.col("parent_season").alias("season"),
        F.col("parent_round").alias("round"),
        F.col("parent_race").alias("raceName"),
        F.col("Results"),
    )
    return shaped.select(F.to_json(doc).alias("json"))


def _block_of(df: DataFrame, order_col: str, blocks: int) -> Callable[[str], F.Column]:
    """Numbers of at most ``blocks`` equal widths of a numeric column's values (one small global aggregate sizes them)."""
    bounds = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    lo = int(bounds["lo"] or 0)
    width = max(1, -(-(int(bounds["hi"] or 0) - lo + 1) // blocks))
    return lambda c: F.floor((F.col(c) - F.lit(lo)) / F.lit(width))


def positions_within(
    df: DataFrame,
    keys: list[str],
    order_col: str,
    blocks_per_key: int = 4096,
    then_by: tuple[str, ...] = (),
) -> DataFrame:
    """0-based position of each row within ``keys`` by ``(order_col, *then_by)``
    (unique per key; ``order_col`` numeric).

    Distributed: rows are numbered inside (keys, block) groups, where blocks
    split the value range of ``order_col`` into at most ``blocks_per_key``
    equal widths (one small global aggregate sizes them). Each block's start
    comes from a running sum over the small table of block counts, so no
    key's rows ever meet in one task and no task sums more than
    ``blocks_per_key`` counts.
    """
    from pyspark.sql import Window

    with_blk = df.withColumn("_blk", _block_of(df, order_col, blocks_per_key)(order_col))
    counts = with_blk.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*keys, "_blk").orderBy(order_col, *then_by)
    ranked = with_blk.withColumn("_r", F.row_number().over(inner))
    return (
        ranked.join(starts, [*keys, "_blk"])
        .withColumn("position", F.col("_start") + F.col("_r") - 1)
        .drop("_blk", "_r", "_start")
    )


ORDER_RECORD_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


def order_pages(spark: SparkSession, sf_dir: str, page_size: int = 30, published_only: bool = False) -> DataFrame:
    """Orders as API pages per season: ``season, offset, json``.

    ``total`` is the season's number of orders. With ``published_only`` the
    pages list only orders not pending (status ``P``) while the total still
    counts them, so the last pages of a season are never served.
    """
    orders = table(spark, sf_dir, "orders").withColumn("season", _s(season_of("o_orderdate")))
    totals = orders.groupBy("season").agg(F.count(F.lit(1)).alias("total"))
    listed = orders.filter(F.col("o_orderstatus") != "P") if published_only else orders
    placed = positions_within(listed, ["season"], "o_orderkey")
    record = F.struct(*[_s(c).alias(c) for c in ORDER_RECORD_FIELDS])
    paged = placed.withColumn("offset", (F.floor(F.col("position") / page_size) * page_size).cast("long"))
    pages = paged.groupBy("season", "offset").agg(F.collect_list(record).alias("Orders"))
    pages = pages.join(totals, "season")
    doc = F.struct(
        F.struct(
            _s("total").alias("total"),
            _s("offset").alias("offset"),
            F.struct(F.col("Orders").alias("Orders")).alias("OrderTable"),
        ).alias("MRData")
    )
    return pages.select("season", "offset", F.to_json(doc).alias("json"))


def land_order_pages(pages: DataFrame, root: str) -> str:
    """Write pages as JSON lines, one folder per key: ``season=<k>/part-*``."""
    pages.drop("offset").write.mode("errorifexists").partitionBy("season").text(root)
    return root


def race_result_pages(
    spark: SparkSession, sf_dir: str, linestatus: str, array_key: str, page_size: int = 30, blocks: int = 4096
) -> DataFrame:
    """API pages of race records nesting result records: ``season, json``.

    Lines with ``linestatus`` become result records under ``array_key``; one
    race record per (order, line number), so an order can span several race
    records and pages. Pages hold ``page_size`` race records, numbered per
    season; ``total`` is the season's count of race records.

    Lines move as few raw columns, once to their order and once to their block of order
    keys, where they are numbered, made into text and put into pages; only the lines of
    pages that lie across blocks are shuffled again.
    """
    from pyspark.sql import Window

    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == linestatus)
    block = _block_of(lines, "l_orderkey", blocks)
    # what ``result_record`` reads of a line beside its parent's keys, as narrow as it can be
    fields = ["l_suppkey", "l_quantity", "l_returnflag", "o_custkey", "l_partkey", "l_shipdate"]
    narrow = {"l_quantity": F.col("l_quantity").cast("bigint"), "l_partkey": F.col("l_partkey") % 20, "l_shipdate": F.trunc("l_shipdate", "year")}
    lines = lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", *[c.alias(n) for n, c in narrow.items()])
    orders = table(spark, sf_dir, "orders")
    raw = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    parent = ["o_orderkey", "l_linenumber", "o_orderdate"]
    keys = [season_of("o_orderdate").alias("season"), block("o_orderkey").alias("_blk")]
    rows = raw.select(*keys, *parent, *fields).where("season IS NOT NULL AND _blk IS NOT NULL").repartition("season", "_blk")

    # races counted with a hash of their lines (each has some), so that all uses of ``rows`` read one shuffle
    races = rows.groupBy("season", "_blk", *parent).agg(F.bit_xor(F.hash(*fields)).alias("_h"))
    counts = races.groupBy("season", "_blk").agg(F.count("_h").alias("_n"))
    season = Window.partitionBy("season")
    before = F.sum("_n").over(season.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("season", "_blk", "_n", F.coalesce(before, F.lit(0)).alias("_start"), F.sum("_n").over(season).alias("total"))
    by_parent = Window.partitionBy("season", "_blk").orderBy(*parent)
    numbers = {"_race": F.dense_rank(), "_line": F.row_number(), "_first": F.rank()}  # a race's first line is its own rank
    numbered = rows.select("*", *[c.over(by_parent).alias(n) for n, c in numbers.items()]).join(starts, ["season", "_blk"])
    position = F.col("_start") + F.col("_race") - 1
    placed = numbered.withColumn("_at", position % page_size).withColumn("offset", (position - position % page_size).cast("long"))
    whole = (F.col("offset") >= F.col("_start")) & (F.least(F.col("offset") + page_size, "total") <= F.col("_start") + F.col("_n"))

    # a page's text is that of its lines in order, a race's first one after the end of the race
    # before and its own race's keys (numbers, nothing to escape)
    of_parent = {"l_orderkey": F.col("o_orderkey"), "l_linestatus": F.lit(linestatus)}
    record = result_record(lambda n: of_parent.get(n, F.col(n)))
    race = {"season": season_of("o_orderdate"), "round": F.dayofyear("o_orderdate"), "raceName": F.col("o_orderkey")}
    named = [x for n, value in race.items() for x in (F.lit(f'"{n}":"'), _s(value), F.lit('",'))]
    opening = F.concat(F.when(F.col("_at") == 0, F.lit("{")).otherwise(F.lit("]},{")), *named, F.lit(f'"{array_key}":['))
    text = F.concat(F.when(F.col("_line") == F.col("_first"), opening).otherwise(F.lit(",")), F.to_json(record))

    def paged(part: DataFrame, *within: str) -> DataFrame:
        pieces = part.select("season", "_blk", "offset", "total", F.struct("_blk", "_line", text.alias("text")).alias("_piece"))
        pages = pieces.groupBy("season", *within, "offset", "total").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
        numbers = [x for n in ("total", "offset") for x in (F.lit(f'"{n}":"'), _s(n), F.lit('",'))]
        races = F.array_join(F.col("_pieces.text"), "")
        page = F.concat(F.lit('{"MRData":{'), *numbers, F.lit('"RaceTable":{"Races":['), races, F.lit("]}]}}}"))
        return pages.select(_s("season").alias("season"), page.alias("json"))

    return paged(placed.where(whole), "_blk").unionByName(paged(placed.where(~whole)))


#: A gzipped file is read by one task; pages of 30 records take some 10 kB of text each.
PAGES_PER_FILE = 10_000


def land_text_pages(pages: DataFrame, root: str) -> str:
    """Write ``season, json`` pages as gzipped JSON lines under ``root/season=<k>/``, in files of bounded size."""
    writer = pages.write.mode("errorifexists").option("compression", "gzip").option("maxRecordsPerFile", PAGES_PER_FILE)
    writer.partitionBy("season").text(root)
    return root


def seasons_present(spark: SparkSession, sf_dir: str) -> list[str]:
    """The partition keys of the analogue (a handful of years; metadata)."""
    years = table(spark, sf_dir, "orders").select(_s(season_of("o_orderdate")).alias("s")).distinct()
    return sorted(r["s"] for r in years.collect())


def race_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as string-typed race records with a two-level ``Circuit`` struct."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return joined.select(
        _s(season_of("o_orderdate")).alias("season"),
        _s(F.dayofyear("o_orderdate")).alias("round"),
        _s(F.col("o_orderdate").cast("date")).alias("date"),
        F.concat(F.date_format("o_orderdate", "HH:mm:ss"), F.lit("Z")).alias("time"),
        _s("o_orderkey").alias("raceName"),
        F.concat(F.lit("http://example.invalid/race/"), _s("o_orderkey")).alias("url"),
        F.struct(
            F.lower(F.regexp_replace("o_orderpriority", " ", "_")).alias("circuitId"),
            F.col("o_orderpriority").alias("circuitName"),
            F.struct(
                F.col("n_name").alias("locality"),
                F.col("n_name").alias("country"),
                _s("n_nationkey").alias("lat"),
                _s("n_regionkey").alias("long"),
            ).alias("Location"),
        ).alias("Circuit"),
    )


def driver_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-season customers as string-typed driver records (some without a family name)."""
    base = drivers(spark, sf_dir).select("season", "driver_id")
    customers = table(spark, sf_dir, "customer")
    joined = base.join(customers, base.driver_id == customers.c_custkey)
    return joined.select(
        _s("season").alias("season"),
        _s("c_custkey").alias("driverId"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(_s("c_nationkey")).alias("permanentNumber"),
        F.substring("c_mktsegment", 1, 3).alias("code"),
        F.col("c_name").alias("givenName"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment"))
        .alias("familyName"),
        _s(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))).alias(
            "dateOfBirth"
        ),
        F.col("c_mktsegment").alias("nationality"),
        F.concat(F.lit("http://example.invalid/driver/"), _s("c_custkey")).alias("url"),
    )


def record_pages(
    records: DataFrame,
    key: str,
    order_col: F.Column,
    container_path: list[str],
    page_size: int = 30,
) -> DataFrame:
    """Any record frame as API pages per ``key``: ``season, json``.

    Records are numbered within their key by ``order_col`` (a unique number
    per key) in bounded blocks, and grouped ``page_size`` to a page.
    """
    fields = [c for c in records.columns if c != key]
    numbered = positions_within(records.withColumn("_ord", order_col), [key], "_ord")
    paged = numbered.withColumn("offset", (F.floor(F.col("position") / page_size) * page_size).cast("long"))
    pages = paged.groupBy(key, "offset").agg(
        F.collect_list(F.struct(F.col(key).alias(key), *fields)).alias("_records")
    )
    totals = records.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
    envelope = F.struct(
        _s("total").alias("total"),
        _s("offset").alias("offset"),
        _nest(F.col("_records"), container_path[1:]).alias(container_path[0]),
    )
    return pages.join(totals, key).select(
        F.col(key).alias("season"), F.to_json(F.struct(envelope.alias("MRData"))).alias("json")
    )


def _nest(col: F.Column, path: list[str]) -> F.Column:
    """``col`` nested under the struct path (innermost last)."""
    for name in reversed(path):
        col = F.struct(col.alias(name))
    return col
