"""Partitioned table writers.

A write into several partitions first asks for a rebalance on the partition
columns: adaptive execution then gives small partitions one file each and splits
a hot partition over several tasks, so neither many tiny files nor one huge
writer task appears.  A write without partition columns, or of a single
partition, keeps the partitioning its rows come in and shuffles nothing.

Folders cannot tell an empty text from NULL, so every writer stores an empty
partition value as NULL: what is written, read back and looked for is the same.
A table that must keep the difference partitions by a derived column instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Partitions named one by one in a filter, at most.
MAX_LISTED_PARTITIONS = 10_000

# Fixed value: the folder name Spark gives a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with empty partition values as NULL, asked to be rebalanced on them."""
    texts = [c for c in by if isinstance(df.schema[c].dataType, StringType)]
    df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df
    return df.hint("rebalance", *by) if by else df


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], *, single: bool = False) -> None:
    """Replace exactly the partitions ``df`` has rows for; create the table if missing.

    Running it twice with the same rows leaves the same table.  ``df`` must not
    read ``path`` itself: materialise it elsewhere first.  ``single`` says that
    all rows belong to one partition, so that nothing needs rebalancing.
    """
    rows = df if single else rebalanced(df, by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def one_partition(df: DataFrame, column: str) -> bool:
    """Whether all rows have the same value of a column, NULL included; reads that column alone."""
    return df.select(column).distinct().limit(2).count() < 2


def append_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Add rows and never touch what is there; a repeated run adds them again."""
    rebalanced(df, by).write.mode("append").partitionBy(*by).parquet(path)


def replace_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Write a whole table to a path of its own."""
    writer = rebalanced(df, by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def land_json_by_date(df: DataFrame, path: str, date_column: str = "date") -> None:
    """Land one folder of JSON lines per date, replacing the dates present."""
    writer = rebalanced(df, [date_column]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(date_column).json(path)


def in_partitions(
    table: DataFrame, wanted: DataFrame, partition: str, *, max_listed: int = MAX_LISTED_PARTITIONS
) -> tuple[DataFrame, int]:
    """The rows of the partitions a one-column frame names, and their number.

    Up to ``max_listed`` values become literals, so only those partitions are
    listed and read; more of them are joined.  The rows are the same both ways.
    An empty text means the NULL partition, as it does to the writers.
    """
    kind = table.schema[partition].dataType
    value = F.col(wanted.columns[0])
    if isinstance(wanted.schema[0].dataType, StringType):
        value = F.nullif(F.nullif(value, F.lit(NULL_PARTITION)), F.lit(""))
    wanted = wanted.select(value.cast(kind).alias("_wanted")).distinct()
    values = [row[0] for row in wanted.limit(max_listed + 1).collect()]
    column = F.nullif(F.col(partition), F.lit("")) if isinstance(kind, StringType) else F.col(partition)
    if len(values) > max_listed:
        return table.join(wanted, column.eqNullSafe(F.col("_wanted")), "left_semi"), wanted.count()
    condition = F.col(partition).isin([v for v in values if v is not None])
    return table.filter(condition | column.isNull() if None in values else condition), len(values)
