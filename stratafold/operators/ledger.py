"""A small record of what each ingest brought, kept in a hidden folder of the table it went to.

One row per ingest and partition: its number, the partition and the rows.  The next number and
the partitions with news follow from it without opening a file of the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratafold.operators.writers import in_partitions
from stratafold.sources.files import scan_table

SCHEMA = "batch long, partition string, rows long, recorded_at timestamp"
FOLDER = "_ingests"

# The number before the first ingest, and that of records that belong to none.
NO_BATCH = 0


def recorded(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger of the table at ``path``; None where there is none."""
    return scan_table(spark, f"{path}/{FOLDER}", StructType.fromDDL(SCHEMA))


def _append(rows: DataFrame, path: str) -> None:
    rows.select("batch", F.col("partition").cast("string").alias("partition"), "rows", "recorded_at").coalesce(1).write.mode("append").parquet(f"{path}/{FOLDER}")


def last_batch(spark: SparkSession, path: str, table: DataFrame | None, batch: str, by: str) -> int:
    """The number of the last ingest.  A table from before its ledger is read once, to begin one."""
    if recorded(spark, path) is None and table is not None:
        counts = table.groupBy(F.coalesce(batch, F.lit(NO_BATCH)).alias("batch"), F.col(by).alias("partition")).agg(F.count("*").alias("rows"))
        _append(counts.withColumn("recorded_at", F.lit(None).cast("timestamp")), path)
    ledger = recorded(spark, path)
    newest = None if ledger is None else ledger.agg(F.max("batch")).first()[0]
    return NO_BATCH if newest is None else newest


def record(rows_per_partition: DataFrame, path: str, batch: int, at: dt.datetime) -> None:
    """Note what ingest ``batch`` is about to write; ``rows_per_partition`` has the partition first, then ``rows``.

    Noted before the rows are written: an ingest that breaks off leaves a note of partitions
    that may have no news, never news without a note.
    """
    partition = F.col(rows_per_partition.columns[0]).alias("partition")
    _append(rows_per_partition.select(F.lit(batch).cast("long").alias("batch"), partition, "rows", F.lit(at).cast("timestamp").alias("recorded_at")), path)


def with_news(table: DataFrame, path: str, batch: str, by: str, seen: int | None) -> DataFrame | None:
    """Rows of ingests after ``seen``, from the partitions the ledger names only; None without news.

    A table without a ledger is looked through.
    """
    since = NO_BATCH - 1 if seen is None else seen
    ledger = recorded(table.sparkSession, path)
    fresh = table.filter(F.col(batch) > F.lit(since)) if seen is not None else table
    if ledger is None:
        return fresh
    news = ledger.filter(F.col("batch") > F.lit(since)).select("partition").distinct()
    if news.isEmpty():
        return None
    return in_partitions(fresh, news, by)[0]


