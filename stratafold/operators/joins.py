"""Joins to small tables, with a checked size before any broadcast hint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratafold.workspace import materialise

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _width(table: DataFrame) -> Column:
    return sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns),
        F.lit(0),
    )


def broadcast_if_small(
    table: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``table`` with a broadcast hint if both bounds hold, else unchanged.

    The check stops reading after ``max_rows + 1`` rows.  Without the hint the
    join shuffles, and adaptive execution splits partitions of hot keys.
    """
    probe = table.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(_width(table)), F.lit(0))).first()
    return F.broadcast(table) if probe[0] <= max_rows and probe[1] <= max_bytes else table


def written_with_size(table: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """``table`` written once to the shared folder, its rows and bytes, counted while it is written."""
    seen = Observation()
    counts = [F.count("*").alias("rows"), F.coalesce(F.sum(_width(table)), F.lit(0)).alias("bytes")]
    kept = materialise(table, label, seen, counts)
    return kept, seen.get["rows"], seen.get["bytes"]


def written_and_measured(
    table: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``table`` written once to the shared folder, with a broadcast hint if it turned out small.

    For tables that cost something to compute.
    """
    kept, rows, size = written_with_size(table, label)
    return F.broadcast(kept) if rows <= max_rows and size <= max_bytes else kept


def missing_references(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows hold each; NULL keys are ignored.

    Child rows are counted per key before the join, so a hot key crosses the
    network once per map task and no join partition grows with it.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("reference"))
        .agg(F.count("*").alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("reference")).distinct()
    return counted.join(known, "reference", "left_anti")
