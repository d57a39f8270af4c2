"""Intermediate tables, what a Python worker gets at a time, and names that no column has."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from loamline.sources.shared import BATCH_BYTES, small_batches, written  # noqa: F401


def release_memory() -> None:
    """Give back what the driver's Python has freed: allocators keep it, and it would count for the rest of the job."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, or with underscores behind it, such that no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage: a lost executor costs at most the tasks that were running, since what was
    written outlives it.
    """
    small_batches(df.sparkSession)
    return written(df, name)
