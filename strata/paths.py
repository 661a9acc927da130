"""Lakehouse layout: ``<root>/<layer>/<dataset>/<model>.<ext>``.

The root comes from an argument, else ``LAKEHOUSE_DATA_ROOT``, else ``../data``.
Bronze tables are folders (``.slices``), silver and gold Parquet folders.
"""

from __future__ import annotations

import os

# The environment variable naming the data root, and its default.
ROOT_ENV = "LAKEHOUSE_DATA_ROOT"
DEFAULT_ROOT = "../data"

BRONZE, SILVER, GOLD = "raw", "staging", "marts"


def data_root(root: str | None = None) -> str:
    return (root or os.environ.get(ROOT_ENV) or DEFAULT_ROOT).rstrip("/")


def dataset_location(layer: str, dataset: str, model: str, root: str | None = None, ext: str = "parquet") -> str:
    return f"{data_root(root)}/{layer}/{dataset}/{model}.{ext}"


def bronze_location(dataset: str, table: str, root: str | None = None) -> str:
    return dataset_location(BRONZE, dataset, table, root, ext="slices")
