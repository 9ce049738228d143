import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratafold.operators.maintenance import (
    compact_partitions,
    expired_versions,
    list_files,
    maintain,
    orphan_files,
    partition_files,
    sweep,
)
from stratafold.operators.quality import QualityError, Rule, run_suite
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import append_partitions
from stratafold.workspace import fresh_path, materialise, shared_root

DAY = dt.datetime(2026, 1, 1)


def at(n):
    return DAY + dt.timedelta(days=n)


def test_publish_and_read(spark, base):
    table = VersionedTable(spark, f"{base}/t")
    assert table.read() is None and table.number() == -1
    for n in range(3):
        table.publish(spark.range(n + 1), at(n))
    assert (table.read().count(), table.number(), table.log().count()) == (3, 2, 3)


def test_a_version_may_be_built_from_the_one_before(spark, base):
    table = VersionedTable(spark, f"{base}/t")
    table.publish(spark.range(3), at(0))
    table.publish(table.read().union(spark.range(2)), at(1))
    assert table.read().count() == 5


def test_failed_audit_leaves_the_table(spark, base):
    table = VersionedTable(spark, f"{base}/t")
    audit = lambda staged: run_suite(staged, ("t", [Rule("rows", "row_count", limit=2)]))
    table.publish(spark.range(2), at(0), audit=audit)
    with pytest.raises(QualityError):
        table.publish(spark.range(1), at(1), audit=audit)
    assert (table.read().count(), table.number()) == (2, 0)


def test_partition_values_keep_their_type(spark, base):
    df = spark.createDataFrame([(1, "007"), (2, None)], "n int, p string")
    table = VersionedTable(spark, f"{base}/t", df.schema)
    staged = table.publish(df, at(0), by=["p"])
    assert sorted(map(str, table.read().collect())) == sorted(map(str, df.collect())) == sorted(map(str, staged.collect()))


@pytest.mark.parametrize("days, keep, gone", [(30, 5, [0, 1, 2, 3, 4]), (30, 1, [0, 1, 2, 3, 4, 5, 6]), (365, 1, []), (0, 12, [])])
def test_expired_versions(spark, days, keep, gone):
    log = spark.createDataFrame([(n, at(n * 5)) for n in range(10)], "version long, published_at timestamp")
    found = expired_versions(log, at(62), retention_days=days, keep=keep)
    assert sorted(r.version for r in found.collect()) == gone


def test_orphan_files(spark):
    files = spark.createDataFrame([("a", at(0)), ("b", at(0)), ("c", at(9))], "path string, modified_at timestamp")
    manifest = spark.createDataFrame([("a",)], "path string")
    assert [r.path for r in orphan_files(files, manifest, at(10)).collect()] == ["b"]


def test_maintain(spark, base, tmp_path):
    table = VersionedTable(spark, f"{base}/t")
    for n in range(4):
        table.publish(spark.range(100 + n).repartition(8), at(n))
    def broken(staged):
        raise RuntimeError("no")
    with pytest.raises(RuntimeError):
        table.publish(spark.range(5), at(4), audit=broken)
    assert len(list(Path(tmp_path, "t", "versions").iterdir())) == 5

    later = dt.datetime.now() + dt.timedelta(days=40)
    done = maintain(table, later, keep=2)
    assert done == {"packed": 1, "expired": 3, "removed": 4}
    assert table.read().count() == 103 and table.log().count() == 2
    assert len(list(Path(tmp_path, "t", "versions").iterdir())) == 2
    # What is packed stays as it is; a write that never ended goes after the grace time.
    Path(tmp_path, "t", "versions", "crashed", "_temporary", "0").mkdir(parents=True)
    soon = dt.datetime.now() + dt.timedelta(days=1)
    assert maintain(table, soon, keep=2) == {"packed": 0, "expired": 0, "removed": 0}
    assert maintain(table, later, keep=2) == {"packed": 0, "expired": 0, "removed": 1}
    on_disk = list(Path(tmp_path, "t", "versions").glob("*/*.parquet"))
    assert list_files(spark, f"{base}/t/versions").count() == len(on_disk)


def test_sweep_skips_absent_tables(spark, base):
    present, absent = VersionedTable(spark, f"{base}/a"), VersionedTable(spark, f"{base}/b")
    present.publish(spark.range(3), at(0))
    assert list(sweep([present, absent], dt.datetime.now())) == [f"{base}/a"]


def test_compaction_of_scattered_partitions_only(spark, base, tmp_path):
    path = f"{base}/t"
    schema = "n int, p string"
    for n in range(3):
        append_partitions(spark.createDataFrame([(n, "a b/c")], schema), path, ["p"])
    append_partitions(spark.createDataFrame([(9, "single")], schema), path, ["p"])
    before = {r.partition: r.files for r in partition_files(spark, path, "p").collect()}
    assert before == {"a b/c": 3, "single": 1}
    table = spark.read.schema(schema).parquet(path)
    assert compact_partitions(table, path, "p") == 1
    assert {r.partition: r.files for r in partition_files(spark, path, "p").collect()} == {"a b/c": 1, "single": 1}
    rows = sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()))
    assert rows == [(0, "a b/c"), (1, "a b/c"), (2, "a b/c"), (9, "single")]
    assert compact_partitions(spark.read.schema(schema).parquet(path), path, "p") == 0


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert fresh_path(spark, "x").startswith(shared_root(spark) + "/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    kept = materialise(spark.range(10).withColumn("s", F.lit("v")), "kept")
    assert kept.count() == 10 and all(shared_root(spark).split(":")[-1] in f for f in kept.inputFiles())
