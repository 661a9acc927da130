"""Declarations: one bronze source, one dataset.

A reader is any ``Callable[[SparkSession, Sequence[str] | None], DataFrame]``:
given the partition keys to load (``None`` for an unpartitioned source) it
returns the records as a DataFrame. For a partitioned source the frame carries
the key of each row in ``KEY_COLUMN`` (the page reader does this from the
landing path); the loader stamps it into the partition column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.sources.pages import PAGE_KEY, WHOLE_RECORD

KEY_COLUMN = PAGE_KEY
#: Column of a record as it landed, with every field it has, beside the declared ones.
RECORD_COLUMN = WHOLE_RECORD

Reader = Callable[[SparkSession, Sequence[str] | None], DataFrame]
Shape = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class SourceSpec:
    """One bronze source.

    ``shape`` is an optional ``DataFrame -> DataFrame`` step (None: records
    land as they are, with a reader of whole records in ``RECORD_COLUMN`` with
    all their fields); ``partition_column`` names the slice column when the
    dataset is partitioned (None: the whole table is replaced on each load).
    ``inventory`` lists the landed pages of the keys (``pages.page_inventory``);
    a load with one accepts a key only if its pages are complete. ``rebalanced``:
    the reader deals its rows out to tasks by key, the load needn't do it again.
    ``shredded``: how whole records are stored (``versioned.SliceTable``).
    """

    name: str
    reader: Reader
    shape: Shape | None = None
    partition_column: str | None = None
    inventory: Reader | None = None
    page_size: int = 30
    rebalanced: bool = False
    shredded: bool = True


@dataclass(frozen=True)
class Dataset:
    """A namespace, its bronze sources and (optionally) its partition keys."""

    name: str
    sources: tuple[SourceSpec, ...]
    partitions: tuple[str, ...] | None = None
    models: dict[str, Callable] = field(default_factory=dict)
    raw_schemas: dict[str, object] = field(default_factory=dict)

    @property
    def partitioned(self) -> bool:
        return self.partitions is not None
