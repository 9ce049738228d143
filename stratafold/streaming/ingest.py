"""Landed files as a stream: each file is taken in once, when it appears.

A file stream does not read a file again that was replaced in place; feeds that
correct a day by replacing its file need the inclusive watermark of
``operators.incremental`` instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratafold.operators.buckets import BucketedTable
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.merge import merge_touched_partitions
from stratafold.operators.versions import Audit, VersionedTable
from stratafold.sources.files import scan_table
from stratafold.workspace import cleans_up, materialise

Step = Callable[[DataFrame | None, DataFrame], DataFrame]
# What is done with a batch, and its number in the stream.
Take = Callable[[DataFrame, int], None]


def keep_latest(keys: Sequence[str], latest_by: str, ties: Sequence[str]) -> Step:
    """A step that keeps each key's latest row, whichever batch brings it.

    Applying a batch twice, or batches in another order, gives the same table.
    """

    def step(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if current is None else current.unionByName(batch)
        return latest_per_key(rows, keys, latest_by, ties)

    return step


def into_versions(table: VersionedTable, step: Step, as_of: dt.datetime | None = None, audit: Audit | None = None) -> Take:
    """Publish ``step(current, batch)`` as the next version, once ``audit`` passes it.

    Every batch rewrites the table: meant for tables that are small next to a
    batch.  Its number is logged with the version, so a batch that comes again after it was
    published is passed over.  One stream feeds a table: another's numbers would be taken for its own.
    """

    def take(batch: DataFrame, number: int) -> None:
        done = table.last_batch()
        if done is None or number > done:
            table.publish(step(table.read(), batch), as_of or dt.datetime.now(), audit=audit, batch=number)

    return take


def into_buckets(table: BucketedTable, step: Step, as_of: dt.datetime | None = None, audit: Audit | None = None) -> Take:
    """Publish ``step`` of each batch and of the buckets that hold its keys, once ``audit`` passes them.

    For tables that are large next to a batch: buckets without a key of the batch keep their
    files, unread.  Keys are dealt out by hash, so a table should have several times as many buckets as a batch
    has keys for that to spare much; other feeds go ``into_partitions`` or ``stream_distinct``.
    A batch that comes again after it was published is passed over.  One stream feeds a table.
    """

    @cleans_up
    def take(batch: DataFrame, number: int) -> None:
        done = table.last_batch()
        if done is None or number > done:
            rows = materialise(batch, "batch")
            table.fold(rows, step, as_of=as_of or dt.datetime.now(), audit=audit, number=number)

    return take


def into_partitions(
    path: str, schema: T.StructType, prepare: Callable[[DataFrame], DataFrame], *, partition: str, **merge_options
) -> Take:
    """Upsert each batch into a partitioned table, rewriting only partitions it concerns.

    ``prepare`` makes a batch's rows unique by key and adds the partition column.
    Repeating a batch writes the same rows again.
    """

    @cleans_up
    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        source = materialise(prepare(batch), "batch")
        if source.isEmpty():
            return
        current = scan_table(spark, path, schema)
        target = spark.createDataFrame([], schema) if current is None else current
        merge_touched_partitions(target, source, path, partition=partition, **merge_options)

    return take


def stream_distinct(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    out: str,
    keys: Sequence[str],
    at: str,
    *,
    late: str,
    checkpoint: str,
    documents: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Append all files not seen before to the table ``out``, each key once, then stop.

    Keys seen are kept in the stream's state, in the checkpoint, from run to run: nothing of
    the table is read or rewritten, and a batch costs what it brings.  A key is kept until its
    time ``at`` lies ``late`` (an interval such as ``2 days``) behind the newest time seen, so
    the state is bound by what comes in such an interval; a row that is later than that is
    dropped, one without a time or with a NULL in a key is kept like any other value.
    Which of several rows of a key in one batch stays is not said, so they should be equal.
    """
    reader = spark.readStream.schema(schema).option("multiLine", documents).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    distinct = reader.json(folder).withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))
    run = distinct.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    run.awaitTermination()


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    take: Take,
    *,
    checkpoint: str,
    documents: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Hand all files not seen before to ``take``, in batches, then stop.

    ``checkpoint`` belongs in shared storage.
    """
    reader = spark.readStream.schema(schema).option("multiLine", documents).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    run = (
        reader.json(folder)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
