"""Table upkeep: compaction, version expiry, orphan files."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F

from stratafold.functions.text import regex_group
from stratafold.operators.buckets import BucketedTable
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import in_partitions, overwrite_partitions, replace_table
from stratafold.sources.files import folder_entries
from stratafold.workspace import delete_folder, materialise

logger = logging.getLogger(__name__)

# How long and how many versions are kept, and the grace for
# files that a write still under way may own.
RETENTION_DAYS = 30
KEEP_VERSIONS = 5
ORPHAN_GRACE_DAYS = 3

# Files smaller than this are small.  Several of them are packed if they are on average smaller by
# the second number: packed files may come out below the size, and are then left alone.
SMALL_FILE_BYTES = 96 * 1024 * 1024
PACK_GAIN = 4


def compact(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Rewrite a table to ``path`` in files of the session's advisory size.

    Small files of a partition are packed together and oversized ones split,
    while the rows stay the same.
    """
    replace_table(df if by else df.hint("rebalance"), path, by)


def partition_files(spark: SparkSession, path: str, by: str, small_file_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """Per partition of a table: its value as text, files, bytes, and how many files are small."""
    # Folder names encode %XX only; a plus sign is one.
    value = F.url_decode(F.replace(regex_group("path", f"/{by}=([^/]+)/"), F.lit("+"), F.lit("%2B")))
    grouped = (
        list_files(spark, path)
        .groupBy(value.alias("partition"))
    )
    return _file_counts(grouped, small_file_bytes)


def _file_counts(grouped: GroupedData, small_file_bytes: int) -> DataFrame:
    small = F.col("length") < small_file_bytes
    return grouped.agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.count_if(small).alias("small_files"),
        F.coalesce(F.sum(F.when(small, F.col("length"))), F.lit(0)).alias("small_bytes"),
    )


def compact_partitions(
    table: DataFrame, path: str, by: str, *, small_file_bytes: int = SMALL_FILE_BYTES
) -> int:
    """Pack the partitions made of several small files; the others stay untouched.

    Returns how many partitions were rewritten.
    """
    files = partition_files(table.sparkSession, path, by, small_file_bytes)
    scattered = materialise(_scattered(files, small_file_bytes).select("partition"), "scattered")
    rows, count = in_partitions(table, scattered, by)
    if count:
        overwrite_partitions(materialise(rows, "packed"), path, [by])
    return count


def compaction_plan(
    files: DataFrame,
    *,
    partition: str = "partition",
    path: str = "path",
    length: str = "length",
    small_file_bytes: int = SMALL_FILE_BYTES,
) -> DataFrame:
    """Which small files make one new file: partition, path, length, bin, bin_files, bin_bytes.

    The small files of a partition are laid end to end, by length, then path, and cut every
    ``small_file_bytes``.  A file alone in its bin stays, as does every file that is not small.
    """
    small = files.filter(F.col(length) < small_file_bytes).select(F.col(partition).alias("partition"), F.col(path).alias("path"), F.col(length).alias("length"))
    before = Window.partitionBy("partition").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(before), F.lit(0))
    binned = small.withColumn("bin", F.floor(start / small_file_bytes).cast("long"))
    bins = binned.groupBy("partition", "bin").agg(F.count("*").alias("bin_files"), F.sum("length").alias("bin_bytes"))
    shared = bins.filter("bin_files > 1").withColumnRenamed("partition", "_p").withColumnRenamed("bin", "_b")
    match = F.col("partition").eqNullSafe(F.col("_p")) & (F.col("bin") == F.col("_b"))
    return binned.join(shared, match).select("partition", "path", "length", "bin", "bin_files", "bin_bytes")


COMPACTION = "_compaction"


def compact_files(
    table: DataFrame, path: str, by: str, *, small_file_bytes: int = SMALL_FILE_BYTES, max_files: int = 10_000
) -> int:
    """Pack the small files that ``compaction_plan`` names and leave all other files alone.

    Returns how many files were replaced, ``max_files`` at most: call it again until it gives 0.
    New files are written aside; what is to be moved and removed is noted first, so a run
    that breaks off is completed by the next one (``finish_compaction``).  Readers should not
    run between: for a moment old and new files are both there.
    """
    spark = table.sparkSession
    finish_compaction(spark, path)
    files = list_files(spark, path).withColumn("partition", regex_group("path", f"/({by}=[^/]+)/"))
    plan = materialise(compaction_plan(files, small_file_bytes=small_file_bytes), "compaction")
    chosen = plan.orderBy("partition", "bin", "path").limit(max_files).select("path").collect()
    if not chosen:
        return 0
    old = [r["path"] for r in chosen]
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*old)
    name = uuid.uuid4().hex
    staged = f"{path}/{COMPACTION}/{name}"
    replace_table(rows, staged, [by])
    new = [r["path"] for r in list_files(spark, staged).select("path").collect()]
    # A note is there whole or not at all: it gets its name last.
    notes = [("move", p) for p in new] + [("remove", p) for p in old]
    written = f"{path}/{COMPACTION}/.{name}"
    spark.createDataFrame(notes, "step string, path string").coalesce(1).write.parquet(written)
    _rename(spark, written, f"{path}/{COMPACTION}/{name}.note")
    finish_compaction(spark, path)
    return len(old)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Complete what the notes of a table's compactions say, and forget what was never noted."""
    root = f"{path}/{COMPACTION}"
    entries = {e.name for e in folder_entries(spark, root)}
    for note in sorted(n for n in entries if n.endswith(".note")):
        staged = f"{root}/{note.removesuffix('.note')}"
        for row in spark.read.parquet(f"{root}/{note}").orderBy("step", "path").collect():
            if row["step"] == "move":
                # <table>/_compaction/<run>/<partition>/<file> goes to <table>/<partition>/<file>.
                folder, file = row["path"].split("/")[-2:]
                _rename(spark, row["path"], f"{path}/{folder}/{file}")
            else:
                delete_folder(spark, row["path"])
        delete_folder(spark, staged)
        delete_folder(spark, f"{root}/{note}")
    for left in {e.name for e in folder_entries(spark, root)}:
        delete_folder(spark, f"{root}/{left}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; one that is not there any more was moved before."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(source):
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"cannot move {old} to {new}")


def expired_versions(
    log: DataFrame,
    as_of: Column | dt.datetime,
    *,
    version: str = "version",
    published_at: str = "published_at",
    retention_days: int = RETENTION_DAYS,
    keep: int = KEEP_VERSIONS,
) -> DataFrame:
    """Versions older than the retention that are not among the ``keep`` newest.

    The newest are a distributed top-k of ``keep`` rows, so they may be
    broadcast whatever the size of the log.
    """
    at = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = (
        log.orderBy(F.col(published_at).desc(), F.col(version).desc())
        .limit(keep)
        .select(F.col(version).alias("_kept"))
    )
    cutoff = at - F.make_dt_interval(F.lit(retention_days))
    old = log.filter(F.col(published_at) < cutoff)
    return old.join(F.broadcast(newest), F.col(version) == F.col("_kept"), "left_anti")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, modification time and length of all files under ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("modificationTime").alias("modified_at"), "length")
    )


def orphan_files(
    files: DataFrame,
    manifest: DataFrame,
    as_of: Column | dt.datetime,
    *,
    path: str = "path",
    modified_at: str = "modified_at",
    grace_days: int = ORPHAN_GRACE_DAYS,
) -> DataFrame:
    """Files past the grace period that no live version lists."""
    at = as_of if isinstance(as_of, Column) else F.lit(as_of)
    settled = files.filter(F.col(modified_at) < at - F.make_dt_interval(F.lit(grace_days)))
    return settled.join(manifest.select(F.col(path).alias("_listed")), F.col(path) == F.col("_listed"), "left_anti")


def _scattered(files: DataFrame, small_file_bytes: int) -> DataFrame:
    """Groups of files (``files`` has small_files and small_bytes) that packing would make far fewer."""
    packed = F.col("small_bytes") < F.col("small_files") * (small_file_bytes / PACK_GAIN)
    return files.filter((F.col("small_files") > 1) & packed)


def needs_packing(spark: SparkSession, path: str, small_file_bytes: int = SMALL_FILE_BYTES) -> bool:
    """Whether some folder of a table has several files so small that packing helps."""
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    return not _scattered(_file_counts(list_files(spark, path).groupBy(folder), small_file_bytes), small_file_bytes).isEmpty()


def unlisted_folders(table: VersionedTable | BucketedTable, as_of: dt.datetime, grace_days: int = ORPHAN_GRACE_DAYS) -> list[str]:
    """Version folders past the grace period that the log does not list, written to the end or not.

    One level of folders is listed: there are as many as versions.  A folder is as old as the
    newest of its direct entries, hidden ones and those of a write under way among them.
    """
    spark = table.spark
    live = table.live_folders()
    limit = (as_of - dt.timedelta(days=grace_days)).timestamp() * 1000
    found = []
    for entry in folder_entries(spark, table.data_path):
        if entry.is_folder and entry.name not in live:
            path = f"{table.data_path}/{entry.name}"
            below = [e.modified_ms for p in (path, f"{path}/_temporary", f"{path}/_temporary/0") for e in folder_entries(spark, p)]
            if max([entry.modified_ms, *below]) < limit:
                found.append(path)
    return found


def maintain(
    table: VersionedTable | BucketedTable,
    as_of: dt.datetime,
    *,
    by: Sequence[str] = (),
    retention_days: int = RETENTION_DAYS,
    keep: int = KEEP_VERSIONS,
    grace_days: int = ORPHAN_GRACE_DAYS,
    small_file_bytes: int = SMALL_FILE_BYTES,
) -> dict[str, int]:
    """Pack the newest version if its files are scattered, expire old ones, remove unlisted folders.

    A table that needs no packing gets no new version; one in buckets never does, as each merge packs those it writes.  Folders are removed one by one
    from the driver: there are as many as expired or failed versions, not as many as files.
    """
    packed = int(isinstance(table, VersionedTable) and needs_packing(table.spark, table.newest_path(), small_file_bytes))
    if packed:
        newest = table.read()
        table.publish(newest if by else newest.hint("rebalance"), as_of, by=by)
    expired = table.expire(
        expired_versions(table.log(), as_of, retention_days=retention_days, keep=keep)
    )
    removed = unlisted_folders(table, as_of, grace_days)
    for path in removed:
        delete_folder(table.spark, path)
    return {"packed": packed, "expired": expired, "removed": len(removed)}


def sweep(tables: Iterable[VersionedTable | BucketedTable], as_of: dt.datetime, **options) -> dict[str, dict[str, int]]:
    """Maintain each table; one that was never written is skipped."""
    done = {}
    for table in tables:
        if table.read() is None:
            logger.info("%s was never written: skipped", table.root)
            continue
        done[table.root] = maintain(table, as_of, **options)
    return done
