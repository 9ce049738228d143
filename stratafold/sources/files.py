"""Scans of landed files with an enforced schema."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Fixed value: a date folder, plain (``/2024-01-31/``) or in ``name=value`` form.
DATE_FOLDER = r"/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})/[^/]+$"


def scan_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    documents: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON files of a folder or glob, read with ``schema`` and nothing inferred.

    ``documents=True`` takes each file as one document (an object or an array of
    objects); such a file cannot be split, so land pages of moderate size.
    Otherwise files hold one object per line and large files are split.
    A value of the wrong type becomes NULL; with ``keep_corrupt`` the text of a
    bad record stays in ``_corrupt_record`` so that it can be quarantined.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", documents)
    return reader.json(path)


def file_date(pattern: str = DATE_FOLDER) -> Column:
    """The date folder a row's file lies in, the empty string if there is none."""
    path = F.col("_metadata.file_path")
    if pattern == DATE_FOLDER:
        # Evaluated for every row: the last folder is found faster without searching those above it.
        path = F.concat(F.lit("/"), F.substring_index(path, "/", -2))
    return F.regexp_extract(path, pattern, 1)


def scan_dated_json(
    spark: SparkSession,
    glob: str,
    schema: T.StructType,
    *,
    date_column: str = "ingestion_date",
    pattern: str = DATE_FOLDER,
    documents: bool = True,
) -> DataFrame | None:
    """All dates of a feed in one scan, the date taken from each file's path.

    A later filter on the date column drops whole files before they are read.
    Gives None when no file matches.
    """
    scan = or_none(lambda: scan_json(spark, glob, schema, documents=documents))
    return None if scan is None else scan.withColumn(date_column, file_date(pattern))


def or_none(read) -> DataFrame | None:
    """``read()``, or None where its path does not exist; other errors pass."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class Entry(NamedTuple):
    """A file or folder: its name, whether it is a folder, and its modification time in milliseconds."""

    name: str
    is_folder: bool
    modified_ms: int


def folder_entries(spark: SparkSession, path: str) -> Iterator[Entry]:
    """What lies directly in a folder, hidden names too; nothing where it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        for status in system.listStatus(folder):
            yield Entry(status.getPath().getName(), status.isDirectory(), status.getModificationTime())


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A parquet table, or None where it was never written."""
    if not path_exists(spark, path):
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def partition(df: DataFrame, column: str, value) -> DataFrame:
    """One partition; on a partition column only its files are listed and read."""
    return df.filter(F.col(column) == F.lit(value))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, *, multi_line: bool = False) -> DataFrame:
    """A dimension kept as CSV with a header line; quotes inside quoted values are doubled.

    ``multi_line`` allows line breaks inside quoted values; such files are not split.
    """
    reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("multiLine", multi_line).csv(path)
