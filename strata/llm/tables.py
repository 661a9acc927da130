"""Reading the given tables and staging intermediate ones in the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Rows of one Arrow batch. Spark cuts batches by rows only, so the default of
#: 10,000 would put gigabytes of long texts into one batch.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, unless PYTHONPATH already does."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.realpath(root) in known or context.applicationId in _shipped:
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata"), "zip", root, "strata")
    context.addPyFile(archive)  # Spark hands it out; executors don't read the driver's folder
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the session's Arrow batch size; a smaller one set by the user stays. Before any Python in tasks."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key))
    if current <= 0 or current > rows:
        spark.conf.set(key, str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that are broadcast at most (of some 50 bytes each).
SMALL = 200_000


def light(df: DataFrame, weight=None, rows: int | None = None) -> DataFrame:
    """A staged table for a join: broadcast if it has at most ``rows`` (default SMALL) rows, else shuffled.

    ``weight``: a column with the number of entries of a row's arrays; five
    times as many entries as rows are allowed.
    """
    most = SMALL if rows is None else rows
    if weight is not None:
        found = df.agg(F.count("*").alias("n"), F.sum(weight).alias("w")).first()
        small = found.n <= most and (found.w or 0) <= 5 * most
    else:
        small = df.limit(most + 1).count() <= most
    return F.broadcast(df) if small else df


def text_of(name: str = "text"):
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
