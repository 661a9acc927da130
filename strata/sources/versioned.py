"""Versioned tables whose slices are replaced whole: two plain Parquet tables.

Under the table's path::

    data/    the rows, with partition columns <slice> and batch_id
    loads/   a row for each slice of each load: version (a partition column),
             slice, batch_id, operation, row_count, record_schema, committed_at

A load appends its rows under a fresh ``batch_id`` (never reused, so a crashed
load cannot mix with its retry), then its rows of ``loads``. What is live at a
version is, for each slice, the batch of the greatest version up to it: a grouped
max over ``loads``, and a predicate on the two partition columns of ``data``. Rows
that no load row names stay invisible; a load row with 0 rows empties its slice.

Limits: one writer for each table (a second one of the same version fails, it is
not a lock); every read lists the folders of all batches, so superseded ones
(see ``superseded``) should be removed now and then, and the folder of a load row
whose write crashed, before the next load.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.specs import RECORD_COLUMN

BATCH = "batch_id"
NO_SLICE = "__all__"
HISTORY_COLUMNS = ["version", "slice", BATCH, "operation", "row_count", "committed_at"]
LOADS_SCHEMA = f"slice string, {BATCH} string, operation string, row_count long, record_schema string, committed_at timestamp"


@dataclass(frozen=True)
class StagedBatch:
    """Rows that are written but in no load yet: their batch, the load's keys, rows and record schema by slice."""

    token: str
    keys: list[str] | None
    counts: dict[str | None, int]
    schemas: dict[str | None, str | None] = field(default_factory=dict)


@dataclass
class SliceTable:
    """A table of slices keyed by ``slice_column`` (``None``: one whole-table slice).

    ``shredded``: whole records are stored as Spark infers it, often used fields in columns of their
    own, where whole numbers of a field that has fractions are fractions too. Else each is stored in
    one piece, as it is, which is far cheaper to write and to read back whole.
    """

    spark: SparkSession
    path: str
    slice_column: str | None = "season"
    slice_type: str = "string"
    shredded: bool = True

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def loads_path(self) -> str:
        return f"{self.path}/loads"

    # ------------------------------------------------------------ metadata

    def loads(self) -> DataFrame:
        """All rows of ``loads``; none for a new table."""
        schema = f"{LOADS_SCHEMA}, version long"
        if not self._exists(self.loads_path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.loads_path).parquet(self.loads_path)

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def version(self) -> int:
        """Current version; -1 for a table without loads."""
        last = self.loads().agg(F.max("version").alias("v")).first().v
        return -1 if last is None else last

    def history(self) -> DataFrame:
        """Every change: (version, slice, batch_id, operation, row_count, committed_at)."""
        return self.loads().where(F.col(BATCH) != "").select(*HISTORY_COLUMNS)

    def live(self, version: int | None = None) -> DataFrame:
        """(slice, batch_id, row_count, record_schema) of every slice at ``version`` (default: current)."""
        loads = self.loads()
        if version is not None:
            if loads.where(F.col("version") == version).isEmpty():
                raise ValueError(f"{self.path} has no version {version}")
            loads = loads.where(F.col("version") <= version)
        newest = F.max_by(F.struct(BATCH, "row_count", "record_schema"), "version").alias("x")
        return loads.where(F.col(BATCH) != "").groupBy("slice").agg(newest).select("slice", "x.*")

    def superseded(self, keep_versions: int = 1) -> DataFrame:
        """(slice, batch_id) of batches that none of the last ``keep_versions`` versions reads.

        Replaced batches and those of loads that never came to an end; remove them
        with the storage's own tools while no load is going on.
        """
        first = max(0, self.version() - keep_versions + 1)
        kept = self.live(first).select("slice", BATCH).union(self.loads().where(F.col("version") > first).select("slice", BATCH))
        there = self._files(T.StructType([])).select(self._slice().alias("slice"), F.col(BATCH)).distinct()
        kept = kept.select(F.col("slice").alias("s"), F.col(BATCH).alias("b"))
        return there.join(kept, there["slice"].eqNullSafe(F.col("s")) & (there[BATCH] == F.col("b")), "left_anti")

    # --------------------------------------------------------------- reads

    def _slice(self) -> Column:
        return F.col(self.slice_column) if self.slice_column else F.lit(NO_SLICE)

    def _parts(self) -> list[str]:
        return ([self.slice_column] if self.slice_column else []) + [BATCH]

    def _files(self, schema: T.StructType | None) -> DataFrame:
        """All written rows, of any batch. Without a schema those of all files are merged."""
        reader = self.spark.read.option("basePath", self.data_path)
        if schema is None:
            schema = reader.option("mergeSchema", True).parquet(self.data_path).schema
        parts = set(self._parts())
        fields = [f for f in schema.fields if f.name not in parts] + [T.StructField(c, T.StringType()) for c in self._parts()]
        return self.spark.read.schema(T.StructType(fields)).option("basePath", self.data_path).parquet(self.data_path)

    def all_rows(self, schema: T.StructType) -> DataFrame:
        """Rows of all batches, live or not, with their ``batch_id``."""
        return self._files(schema)

    def _of(self, batches: Sequence[tuple[str | None, str]]) -> Column:
        """A predicate on the partition columns: the rows of (slice, batch) pairs."""
        if self.slice_column is None:
            return F.col(BATCH).isin([b for _, b in batches])
        by_batch: dict[str, list] = {}
        for s, b in batches:
            by_batch.setdefault(b, []).append(s)
        return reduce(Column.__or__, ((F.col(BATCH) == b) & self._in(slices) for b, slices in by_batch.items()))

    def _in(self, slices: Sequence[str | None]) -> Column:
        named = F.col(self.slice_column).isin([s for s in slices if s is not None])
        return named | F.col(self.slice_column).isNull() if None in slices else named

    def _read(self, batches: Sequence[tuple[str | None, str]], schema: T.StructType | None) -> DataFrame:
        if batches:
            rows = self._files(schema).where(self._of(batches))
        else:
            parts = [T.StructField(c, T.StringType()) for c in self._parts()]
            kept = [f for f in (schema or T.StructType([])).fields if f.name not in self._parts()]
            rows = self.spark.createDataFrame([], T.StructType(kept + parts))
        if self.slice_column is not None and self.slice_type != "string":
            rows = rows.withColumn(self.slice_column, F.col(self.slice_column).cast(self.slice_type))
        return rows

    def read(
        self,
        version: int | None = None,
        schema: T.StructType | None = None,
        slices: Sequence[str] | None = None,
        keep_batch: bool = False,
    ) -> DataFrame:
        """Rows of the table at ``version`` (default: current).

        ``schema`` is the declared data schema (preferred: no footer reads; columns
        that files lack are NULL). Without it the schemas of all files are merged, so a
        column stays once a load had it. The slice column is a string.
        """
        live = self.live(version).where("row_count > 0")
        if slices is not None:
            live = live.where(F.col("slice").isin([str(s) for s in slices]))
        rows = self._read([(r["slice"], r[BATCH]) for r in live.collect()], schema)  # one for each slice
        return rows if keep_batch else rows.drop(BATCH)

    # -------------------------------------------------------------- writes

    def _write(self, df: DataFrame, batch: Column) -> None:
        writer = df.withColumn(BATCH, batch).write.mode("append").option("compression", "zstd")  # whole records repeat much
        if not self.shredded:
            writer = writer.option("spark.sql.variant.inferShreddingSchema", "false")
        writer.partitionBy(*self._parts()).parquet(self.data_path)

    def _written(self, batch: Column, whole: bool) -> DataFrame:
        """(slice, batch_id, row_count, record_schema) of batches, from their files (``whole``: which hold whole records)."""
        record = T.StructType([T.StructField(RECORD_COLUMN, T.VariantType())] if whole else [])
        if not self._exists(self.data_path):  # a first load without rows
            return self.spark.createDataFrame([], f"slice string, {BATCH} string, row_count long, record_schema string")
        rows = self._files(record).where(batch).groupBy(self._slice().alias("slice"), BATCH)
        schema = F.expr(f"schema_of_variant_agg({RECORD_COLUMN})") if whole else F.lit(None).cast("string")
        return rows.agg(F.count(F.lit(1)).alias("row_count"), schema.alias("record_schema"))

    @staticmethod
    def _whole(df: DataFrame) -> bool:
        return any(f.name == RECORD_COLUMN and isinstance(f.dataType, T.VariantType) for f in df.schema.fields)

    def _append(self, version: int, rows: list[tuple]) -> int:
        """Write load ``version``; fails if a folder of it is there, another writer's or a crashed one's."""
        frame = self.spark.createDataFrame(rows, LOADS_SCHEMA).coalesce(1)
        frame.write.mode("errorifexists").parquet(f"{self.loads_path}/version={version}")
        return version

    @staticmethod
    def _now() -> _dt.datetime:
        return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def create(self) -> int:
        """Version 0 of a new table, without slices (nothing if it exists)."""
        return self._append(0, [(None, "", "CREATE", 0, None, self._now())]) if self.version() < 0 else self.version()

    def stage(
        self, df: DataFrame, keys: Sequence[str] | None = None, files_per_slice: int | None = None, rebalanced: bool = False
    ) -> StagedBatch:
        """Write ``df`` as a new batch that no reader sees until :meth:`commit`.

        Rows are rebalanced on the slice: a large slice is written by as many tasks as
        its size asks for, small ones share a task. ``files_per_slice`` fixes the number;
        ``rebalanced`` says that ``df`` has been rebalanced on the slice and writes it as it is.
        """
        token = uuid.uuid4().hex
        if self.slice_column is None:
            keys = [NO_SLICE]
        elif keys is not None:
            df = self._only_keys(df, keys)
        whole = self._whole(df)
        if files_per_slice:
            df = self._spread(df, files_per_slice)
        elif self.slice_column and not rebalanced:
            df = df.hint("rebalance", self.slice_column)
        self._write(df, F.lit(token))
        written = self._written(F.col(BATCH) == token, whole).collect()  # one for each slice
        counts = {r["slice"]: r["row_count"] for r in written}
        return StagedBatch(token, None if keys is None else [str(k) for k in keys], counts, {r["slice"]: r["record_schema"] for r in written})

    def read_staged(self, staged: StagedBatch, schema: T.StructType | None = None) -> DataFrame:
        """The rows of a staged batch (for tests before committing it)."""
        return self._read([(s, staged.token) for s in staged.counts], schema).drop(BATCH)

    def commit(self, staged: StagedBatch, operation: str = "WRITE", replace_all: bool = False) -> int:
        """Make a staged batch the live one of its slices; returns the new version.

        Every key of the load gets a row, also one without rows: that is what empties
        a slice. Without keys the slices written are replaced; with ``replace_all``
        every other live slice is emptied too (a full rebuild).
        """
        wanted = list(staged.keys) if staged.keys is not None else sorted(staged.counts, key=lambda k: (k is None, k or ""))
        if replace_all:
            wanted += [r["slice"] for r in self.live().where("row_count > 0").collect() if r["slice"] not in wanted]
        now = self._now()
        rows = [(k, staged.token, operation, staged.counts.get(k, 0), staged.schemas.get(k), now) for k in wanted]
        return self._append(self.version() + 1, rows or [(None, "", operation, 0, None, now)])

    def load(
        self,
        df: DataFrame,
        keys: Sequence[str] | None = None,
        operation: str = "WRITE",
        replace_all: bool = False,
        files_per_slice: int | None = None,
        rebalanced: bool = False,
    ) -> int:
        """Replace the slices ``keys`` with the rows of ``df``; returns the new version.

        ``df`` carries the slice column (see :meth:`stamp`); see :meth:`stage`
        and :meth:`commit`.
        """
        return self.commit(self.stage(df, keys, files_per_slice, rebalanced), operation, replace_all)

    def _spread(self, df: DataFrame, files_per_slice: int) -> DataFrame:
        hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        salt = F.pmod(F.xxhash64(*hashable), F.lit(files_per_slice)) if hashable else F.lit(0)
        return df.repartition(*([F.col(self.slice_column)] if self.slice_column else []), salt)

    def _only_keys(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Fail the write on a row whose slice is not one of the load's keys.

        Checked inside the write job (no extra pass); rows written before the failure
        stay invisible.
        """
        col = F.col(self.slice_column)
        message = F.concat(F.lit("row for a slice outside the load's keys: "), F.coalesce(col, F.lit("NULL")))
        return df.withColumn(self.slice_column, F.when(col.isin([str(k) for k in keys]), col).otherwise(F.raise_error(message)))

    def load_slice(self, df: DataFrame, key: str, operation: str = "WRITE") -> int:
        """Replace one slice; the key is stamped over any same-named column."""
        return self.load(self.stamp(df, key), [key], operation)

    def stamp(self, df: DataFrame, key: str) -> DataFrame:
        """Set the slice column to the literal key (overrides a source column)."""
        return df if self.slice_column is None else df.withColumn(self.slice_column, F.lit(str(key)))

    def load_versions(self, df: DataFrame, version_column: str, operation: str = "WRITE") -> list[int]:
        """Replay a sequence of loads in one write job (a backfill with history).

        ``version_column`` holds, per row, the version of the load that wrote it; the
        versions must continue the table's (current + 1, + 2, ...). Each version
        replaces the slices it has rows for. The first version's load row claims the
        sequence: a second writer fails there. The others follow in one job.
        """
        current, token = self.version(), uuid.uuid4().hex
        parts = [self.slice_column] if self.slice_column else []
        whole = self._whole(df)
        self._write(df.hint("rebalance", *parts, version_column), F.concat(F.lit(f"{token}-"), F.col(version_column).cast("string")))
        loads = self._written(F.col(BATCH).startswith(f"{token}-"), whole).withColumn("version", F.substring_index(BATCH, "-", -1).cast("long"))
        versions = [r.version for r in loads.select("version").distinct().orderBy("version").collect()]
        if versions != list(range(current + 1, current + 1 + len(versions))):
            raise ValueError(f"versions must continue the table at {current + 1}; got {versions[0]}..{versions[-1]} (the written rows stay invisible)")
        if not versions:
            return versions
        loads = loads.select("slice", BATCH, F.lit(operation).alias("operation"), "row_count", "record_schema", F.lit(self._now()).alias("committed_at"), "version")
        first = loads.where(F.col("version") == versions[0]).drop("version")
        first.coalesce(1).write.mode("errorifexists").parquet(f"{self.loads_path}/version={versions[0]}")
        rest = loads.where(F.col("version") > versions[0])
        rest.repartition("version").write.mode("append").partitionBy("version").parquet(self.loads_path)
        return versions
