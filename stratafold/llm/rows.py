"""Small helpers the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Rows turned into Python objects at a time; Arrow batches can hold thousands of long texts.
SLICE_ROWS = 256

# The C library's call for that, where it has one (glibc).
try:
    _TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
except (OSError, TypeError):
    _TRIM = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, few at a time, so that memory does not follow the batch size."""
    release_memory()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
    release_memory()


def release_memory() -> None:
    """Give back to the system what was freed: Python workers live on, and what one task needed stays with them."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def unused_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores until no column of ``df`` has that name (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish
