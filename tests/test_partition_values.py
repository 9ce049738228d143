"""Partition values that folder names treat specially, through every writer."""

import datetime as dt

import pytest

from stratafold.operators.maintenance import compact_partitions, partition_files
from stratafold.operators.merge import merge_newer, merge_table, merge_touched_partitions
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import append_partitions, overwrite_partitions, replace_table

SCHEMA = "n int, p string"
VALUES = [None, "", " ", "a b", "a+b", "a%20b", "a/b", "x=y"]
ROWS = list(enumerate(VALUES))


def stored(rows):
    """Folders cannot tell an empty text from NULL."""
    return sorted(((n, p or None) for n, p in rows), key=str)


def content(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


@pytest.mark.parametrize("write", [overwrite_partitions, append_partitions, replace_table])
def test_writers_keep_every_row(spark, base, write):
    write(spark.createDataFrame(ROWS, SCHEMA), f"{base}/t", ["p"])
    assert content(spark, f"{base}/t") == stored(ROWS)


def test_versions_keep_every_row(spark, base):
    df = spark.createDataFrame(ROWS, SCHEMA)
    table = VersionedTable(spark, f"{base}/t", df.schema)
    table.publish(df, dt.datetime(2026, 1, 1), by=["p"])
    assert sorted(map(tuple, table.read().collect()), key=str) == stored(ROWS)


@pytest.mark.parametrize("value", VALUES)
def test_touched_partitions_keep_what_they_hold(spark, base, value):
    overwrite_partitions(spark.createDataFrame(ROWS, SCHEMA), f"{base}/t", ["p"])
    target = spark.read.schema(SCHEMA).parquet(f"{base}/t")
    merge_touched_partitions(
        target, spark.createDataFrame([(99, value)], SCHEMA), f"{base}/t",
        partition="p", keys=["n"], update=[], active=None, stamped=None,
    )
    assert content(spark, f"{base}/t") == stored([*ROWS, (99, value)])


def test_compaction_keeps_every_row(spark, base):
    rows = [(10 * k + n, p) for k in range(3) for n, p in ROWS]
    for k in range(3):
        append_partitions(spark.createDataFrame(rows[k * len(ROWS) : (k + 1) * len(ROWS)], SCHEMA), f"{base}/t", ["p"])
    packed = compact_partitions(spark.read.schema(SCHEMA).parquet(f"{base}/t"), f"{base}/t", "p")
    assert packed == len(VALUES) - 1  # NULL and empty text share a folder
    assert content(spark, f"{base}/t") == stored(rows)
    assert all(r.files == 1 for r in partition_files(spark, f"{base}/t", "p").collect())


def test_one_large_file_does_not_hide_small_ones(spark, base):
    append_partitions(spark.range(200_000).selectExpr("CAST(id AS INT) AS n", "'a' AS p").coalesce(1), f"{base}/t", ["p"])
    for n in range(25):
        append_partitions(spark.createDataFrame([(n, "a")], SCHEMA), f"{base}/t", ["p"])
    assert compact_partitions(spark.read.schema(SCHEMA).parquet(f"{base}/t"), f"{base}/t", "p", small_file_bytes=100_000) == 1


def test_the_first_load_checks_keys_too(spark):
    df = spark.createDataFrame([(1, "2026"), (1, "2026")], "k int, at string")
    with pytest.raises(Exception, match="several rows of one key"):
        merge_newer(None, df, keys=["k"], changed_at="at").collect()


@pytest.mark.parametrize("inclusive, found", [(False, "old"), (True, "late")])
def test_strictness_of_an_increment(spark, inclusive, found):
    target = spark.createDataFrame([(1, "2026", "old")], "k int, at string, v string")
    late = spark.createDataFrame([(1, "2026", "late")], "k int, at string, v string")
    assert merge_newer(target, late, keys=["k"], changed_at="at", inclusive=inclusive).first().v == found


def test_merge_is_whole_without_news(spark):
    target = spark.createDataFrame(ROWS, SCHEMA)
    same = merge_table(target, target.limit(0), keys=["n"], update=["p"], active=None, stamped=None)
    assert sorted(map(tuple, same.collect()), key=str) == sorted(ROWS, key=str)
