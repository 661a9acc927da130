"""Landed JSON pages → record rows, and a completeness check of the pages.

A fetcher (outside this library) lands each API page as one JSON document:

    <root>/<dataset>/<endpoint>/<key_column>=<key>/offset=<n>/page.json

or many pages of a key as JSON lines under ``<key_column>=<key>/``, each page
carrying its ``offset`` in the envelope (far fewer files at scale).

Each page is ``{envelope_key: {total_key: "70", <container path>: [records]}}``.
A page that can't be parsed, or that lacks the envelope or the container (an
error body, a truncated download), fails the read with its key and file; an
empty container is a page without records. ``landing_problems`` lists what keeps
a key's landing from being complete.

Reading is a narrow plan: JSON scan → ``explode`` of the container array →
``select``; tasks follow the page files, nothing is shuffled and no page goes
through the driver. ``multi_line=False`` reads JSON-lines files (one page per
line), which Spark can split; one-document files need ``multi_line=True``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalars import field_path, type_text

# Names of the paged API's envelope (``MRData``, ``total``, ``offset``, 30 records a
# page) are fixed values of the source; all are parameters below.
PAGE_KEY = "_page_key"
PAGE_OFFSET = "_page_offset"
OFFSET_DIR = "offset"
DAMAGED = "_damaged_page"
WHOLE_RECORD = "record"


def endpoint_location(template: str, key: str | None = None) -> str:
    """A location with an optional ``{partition}`` placeholder filled by ``key``.

    Without the placeholder the location is used verbatim.
    """
    if "{partition}" in template and key is not None:
        return template.format(partition=key)
    return template


def envelope_schema(
    container_path: Sequence[str],
    record: T.DataType,
    envelope_key: str = "MRData",
    total_key: str = "total",
    offset_key: str = "offset",
) -> T.StructType:
    """Declared schema of one page: the envelope, its total and offset, the records (a struct or a VARIANT each)."""
    inner: T.DataType = T.ArrayType(record)
    for name in reversed(container_path):
        inner = T.StructType([T.StructField(name, inner)])
    assert isinstance(inner, T.StructType)
    fields = [T.StructField(total_key, T.StringType()), T.StructField(offset_key, T.StringType())]
    fields += list(inner.fields)
    return T.StructType([T.StructField(envelope_key, T.StructType(fields))])


def _read_envelopes(
    spark: SparkSession,
    endpoint_root: str,
    schema: T.StructType,
    key_column: str,
    keys: Sequence[str] | None,
    multi_line: bool,
    offset_key: str = "offset",
) -> DataFrame:
    full = T.StructType(
        list(schema.fields)
        + [
            T.StructField(key_column, T.StringType()),
            T.StructField(OFFSET_DIR, T.LongType()),
            T.StructField(DAMAGED, T.StringType()),
        ]
    )
    pages = (
        spark.read.schema(full)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        .option("basePath", endpoint_root)
        .json(endpoint_root)
    )
    if keys is not None:
        pages = pages.filter(F.col(key_column).isin([str(k) for k in keys]))
    # The offset comes from an ``offset=<n>`` folder when the landing has one
    # (one file per page), else from the envelope (many pages per file).
    envelope_offset = F.col(f"{schema.fields[0].name}.{offset_key}").try_cast("long")
    return pages.withColumn(OFFSET_DIR, F.coalesce(F.col(OFFSET_DIR), envelope_offset))


def read_pages(
    spark: SparkSession,
    endpoint_root: str,
    record: T.StructType,
    container_path: Sequence[str],
    *,
    keys: Sequence[str] | None = None,
    key_column: str = "season",
    envelope_key: str = "MRData",
    total_key: str = "total",
    multi_line: bool = True,
    whole: str | None = None,
    rebalance: bool = False,
) -> DataFrame:
    """All records of the landed pages of the given keys, one row per record.

    A page with an empty container adds no row, a damaged one fails; a parent record
    split over two pages contributes both parts (no de-duplication). The
    columns are the record's fields plus ``_page_key`` and ``_page_offset``.

    ``whole`` names a further column for the record as it landed, a VARIANT: fields
    that no schema declares stay in it, to be read by path (``variant_get``) or
    with the schema that all loads' records have together (``growth.read_grown``).
    The declared fields are taken from it, in the same pass; a declared field of
    another kind than the record's (a struct for a number, say) fails the read.

    ``rebalance`` deals the records out to tasks by key, for a load that writes them by
    key: each moves once, as it landed, before its fields are read and repeated beside it.
    """
    schema = envelope_schema(container_path, T.VariantType() if whole else record, envelope_key, total_key)
    pages = _read_envelopes(spark, endpoint_root, schema, key_column, keys, multi_line)
    container = field_path(envelope_key, *container_path)
    message = F.concat(F.lit("damaged page of key "), F.coalesce(F.col(key_column), F.lit("?")), F.lit(" in "), F.col("_metadata.file_path"))
    records = F.when(F.col(DAMAGED).isNotNull() | container.isNull(), F.raise_error(message)).otherwise(container)
    exploded = pages.select(
        F.col(key_column).alias(PAGE_KEY),
        F.col(OFFSET_DIR).alias(PAGE_OFFSET),
        F.explode(records).alias("_r"),
    )
    if rebalance:
        exploded = exploded.hint("rebalance", PAGE_KEY)
    if whole:
        declared = F.variant_get(F.col("_r"), "$", type_text(record))
        exploded = exploded.select(PAGE_KEY, PAGE_OFFSET, declared.alias("_d"), F.col("_r").alias(whole))
        return exploded.select("_d.*", whole, PAGE_KEY, PAGE_OFFSET)
    return exploded.select("_r.*", PAGE_KEY, PAGE_OFFSET)


def page_inventory(
    spark: SparkSession,
    endpoint_root: str,
    container_path: Sequence[str],
    *,
    keys: Sequence[str] | None = None,
    key_column: str = "season",
    envelope_key: str = "MRData",
    total_key: str = "total",
    multi_line: bool = True,
) -> DataFrame:
    """One row per landed page: key, offset, reported total, record count, whether it is damaged."""
    record = T.StructType([])
    schema = envelope_schema(container_path, record, envelope_key, total_key)
    pages = _read_envelopes(spark, endpoint_root, schema, key_column, keys, multi_line)
    container = field_path(envelope_key, *container_path)
    total = F.col(f"{envelope_key}.{total_key}").try_cast("long")
    return pages.select(
        F.col(key_column).alias("key"),
        F.col(OFFSET_DIR).alias("offset"),
        total.alias("total"),
        F.when(container.isNull(), F.lit(0)).otherwise(F.size(container)).alias("records"),
        (F.col(DAMAGED).isNotNull() | container.isNull() | total.isNull()).alias("damaged"),
    )


#: Landed pages of a key that are looked at in one window.
RANGE = 1 << 16


def missing_ranges(inventory: DataFrame, page_size: int, span: int = RANGE) -> DataFrame:
    """Gaps in the landed pages: ``key, first_offset, last_offset, n_pages`` of each run of missing pages.

    Pages are due at offsets 0, size, 2 * size, ... below the key's total (its greatest
    reported one), and at 0 in any case. Gaps are found from landed pages alone, in two levels:
    within ranges of ``span`` pages, each page against the one before it; then,
    from the first and last page of every range that has any, between ranges and up
    to the total. Work and windows follow the landed pages, however large a total is.
    """
    totals = inventory.groupBy("key").agg(F.max("total").alias("total"))
    totals = totals.where("key IS NOT NULL AND total IS NOT NULL")
    last = F.greatest(F.ceil(F.col("total") / F.lit(page_size)), F.lit(1)).cast("long") - 1
    page = (F.col("offset") / F.lit(page_size)).cast("long")
    landed = inventory.where((F.col("offset") >= 0) & (F.col("offset") % page_size == 0)).select("key", page.alias("page")).distinct()
    landed = landed.withColumn("range", F.floor(F.col("page") / F.lit(span)))
    before = F.lag("page").over(Window.partitionBy("key", "range").orderBy("page"))
    inside = landed.select("key", (before + 1).alias("lo"), (F.col("page") - 1).alias("hi"))

    ends = landed.groupBy("key", "range").agg(F.min("page").alias("first"), F.max("page").alias("final"))
    border = F.coalesce(F.lag("final").over(Window.partitionBy("key").orderBy("range")), F.lit(-1))  # one row for each range
    between = ends.select("key", (border + 1).alias("lo"), (F.col("first") - 1).alias("hi"))
    final = ends.groupBy("key").agg(F.max("final").alias("final"))
    known = totals.select("key", last.alias("last"))
    after = known.join(final, "key", "left").select("key", (F.coalesce("final", F.lit(-1)) + 1).alias("lo"), F.col("last").alias("hi"))
    gaps = inside.union(between).union(after).join(known, "key").withColumn("hi", F.least("hi", "last")).where("lo <= hi")
    size = F.lit(page_size).cast("long")
    return gaps.select("key", (F.col("lo") * size).alias("first_offset"), (F.col("hi") * size).alias("last_offset"), (F.col("hi") - F.col("lo") + 1).alias("n_pages"))


def missing_pages(inventory: DataFrame, page_size: int, chunk: int = RANGE) -> DataFrame:
    """Pages a complete walk would have fetched but that are not landed.

    Returns ``key, offset, reason``: ``missing`` for each page of ``missing_ranges``
    (long ranges are written out ``chunk`` pages at a time, spread over tasks);
    ``empty_before_total`` for a landed page without records although the total
    says more exist (where a fetch walk would stop early).
    """
    ranges = missing_ranges(inventory, page_size)
    size = F.lit(page_size).cast("long")
    starts = F.sequence("first_offset", "last_offset", size * chunk)
    chunks = ranges.select("key", "last_offset", F.explode(starts).alias("lo")).repartition("key", "lo")
    offsets = F.sequence(F.col("lo"), F.least(F.col("lo") + size * (chunk - 1), F.col("last_offset")), size)
    absent = chunks.select("key", F.explode(offsets).alias("offset"), F.lit("missing").alias("reason"))
    totals = inventory.groupBy("key").agg(F.max("total").alias("_t"))
    early = (
        inventory.join(totals, ["key"])
        .filter((F.col("records") == 0) & (F.col("offset") < F.col("_t")))
        .select("key", "offset", F.lit("empty_before_total").alias("reason"))
    )
    return absent.unionByName(early)


def landing_problems(inventory: DataFrame, page_size: int) -> DataFrame:
    """Everything that keeps a landing from being complete: ``key, offset, reason``.

    The reasons of ``missing_pages``, and ``damaged`` (no envelope, container or
    total) and ``duplicate`` (an offset landed more than once, or unknown).
    """
    damaged = inventory.filter("damaged").select("key", "offset", F.lit("damaged").alias("reason"))
    sound = inventory.filter("NOT damaged")
    again = sound.groupBy("key", "offset").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR offset IS NULL")
    again = again.select("key", "offset", F.lit("duplicate").alias("reason"))
    return missing_pages(sound, page_size).unionByName(damaged).unionByName(again)
