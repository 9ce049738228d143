import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stratafold.operators.buckets import BucketedTable
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.quality import Rule, run_suite
from stratafold.operators.versions import VersionedTable
from stratafold.streaming.ingest import into_buckets, into_partitions, into_versions, keep_latest, stream_files

SCHEMA = "id string, v int, at int"


def land(tmp_path, name, *rows):
    folder = tmp_path / "landed" / "2026-01-15"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps([dict(zip(("id", "v", "at"), r)) for r in rows]))


def test_each_file_is_taken_once_in_any_order(spark, tmp_path, base):
    table = VersionedTable(spark, f"{base}/t")
    take = into_versions(table, keep_latest(["id"], "at", ["v"]), dt.datetime(2026, 1, 15))

    def run():
        stream_files(spark, f"{base}/landed", SCHEMA, take, checkpoint=f"{base}/progress", files_per_batch=1)
        return sorted(map(tuple, table.read().collect()))

    land(tmp_path, "1.json", ("a", 5, 5), ("b", 1, 1))
    assert run() == [("a", 5, 5), ("b", 1, 1)]
    land(tmp_path, "2.json", ("a", 3, 3), ("b", 2, 2), ("c", 1, 1))
    assert run() == [("a", 5, 5), ("b", 2, 2), ("c", 1, 1)]
    number = table.number()
    run()
    assert table.number() == number


def test_rejected_batch_is_not_published(spark, tmp_path, base):
    table = VersionedTable(spark, f"{base}/t")
    audit = lambda staged: run_suite(staged, ("t", [Rule("ids", "missing_count", ("id",))]))
    take = into_versions(table, keep_latest(["id"], "at", ["v"]), dt.datetime(2026, 1, 15), audit)
    land(tmp_path, "1.json", (None, 1, 1))
    with pytest.raises(Exception, match="ids"):
        stream_files(spark, f"{base}/landed", SCHEMA, take, checkpoint=f"{base}/progress")
    assert table.read() is None


def test_bucketed_target(spark, tmp_path, base):
    table = BucketedTable(spark, f"{base}/t", spark.createDataFrame([], SCHEMA).schema, ("id",), 16, active=None, stamped=None)
    rules = ("t", [Rule("ids", "missing_count", ("id",))])
    take = into_buckets(table, keep_latest(["id"], "at", ["v"]), dt.datetime(2026, 1, 15), lambda staged: run_suite(staged, rules))

    def run():
        stream_files(spark, f"{base}/landed", SCHEMA, take, checkpoint=f"{base}/progress", files_per_batch=1)
        return sorted(map(tuple, table.read().collect()))

    land(tmp_path, "1.json", ("a", 5, 5), ("b", 1, 1), ("c", 2, 2))
    assert run() == [("a", 5, 5), ("b", 1, 1), ("c", 2, 2)]
    before = set(table.read().inputFiles())
    land(tmp_path, "2.json", ("a", 3, 3), ("a", 6, 6))
    assert run() == [("a", 6, 6), ("b", 1, 1), ("c", 2, 2)]
    assert len(before & set(table.read().inputFiles())) == len(before) - 1
    number = table.number()
    run()
    take(spark.createDataFrame([("a", 9, 9)], SCHEMA), 1)
    assert table.number() == number
    land(tmp_path, "3.json", (None, 1, 1))
    with pytest.raises(Exception, match="ids"):
        run()
    assert table.number() == number


def test_partitioned_target(spark, tmp_path, base):
    stored = spark.createDataFrame([], "id string, v int, at int, p string").schema
    take = into_partitions(
        f"{base}/t",
        stored,
        lambda batch: latest_per_key(batch, ["id"], "at", ["v"]).withColumn("p", F.col("id").substr(1, 1)),
        partition="p",
        keys=["id"],
        update=["v", "at"],
        active=None,
        stamped=None,
        source_is_unique=True,
    )
    for n, rows in enumerate([[("a1", 1, 1), ("b1", 1, 1)], [("a1", 2, 2), ("a1", 1, 1), ("a2", 1, 1)]]):
        land(tmp_path, f"{n}.json", *rows)
        stream_files(spark, f"{base}/landed", SCHEMA, take, checkpoint=f"{base}/progress")
    rows = spark.read.schema(stored).parquet(f"{base}/t").collect()
    assert sorted((r.id, r.v) for r in rows) == [("a1", 2), ("a2", 1), ("b1", 1)]
