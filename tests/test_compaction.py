"""Packing of single files: only small ones that share a bin are rewritten."""

import random

from pyspark.sql import functions as F

from stratafold.operators.maintenance import COMPACTION, compact_files, compaction_plan, finish_compaction
from stratafold.operators.writers import append_partitions

SCHEMA = "part string, i long, text string"


def files_of(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part=*/*.parquet")}


def lots(spark, base, large=20_000, small=25):
    random.seed(1)
    text = lambda n: "".join(random.choices("abcdefghij", k=n))
    append_partitions(spark.createDataFrame([("a", -1 - i, text(200)) for i in range(large // 200)], SCHEMA).coalesce(1), f"{base}/t", ["part"])
    for lot in range(small):
        append_partitions(spark.createDataFrame([(p, lot, text(40)) for p in ("a", None)], SCHEMA).coalesce(1), f"{base}/t", ["part"])
    append_partitions(spark.createDataFrame([("b c+%", 7, "x")], SCHEMA), f"{base}/t", ["part"])
    return spark.read.schema(SCHEMA).parquet(f"{base}/t")


def rows_of(spark, base):
    return sorted(map(str, spark.read.schema(SCHEMA).parquet(f"{base}/t").collect()))


def test_a_large_file_and_one_alone_are_left(spark, base, tmp_path):
    table = lots(spark, base)
    before, rows = files_of(tmp_path), rows_of(spark, base)
    assert len(before) == 52
    assert compact_files(table, f"{base}/t", "part", small_file_bytes=10_000) == 50
    after = files_of(tmp_path)
    kept = set(before) & set(after)
    assert {p.parent.name for p in kept} == {"part=a", "part=b c+%25"} and all(before[p] == after[p] for p in kept)
    assert len(kept) == 2 and len(after) < 12 and rows_of(spark, base) == rows
    assert not any((tmp_path / "t" / COMPACTION).iterdir())


def test_rounds_of_few_files_end(spark, base):
    table = lots(spark, base, small=6)
    rows = rows_of(spark, base)
    counts = []
    while not counts or counts[-1]:
        counts.append(compact_files(spark.read.schema(SCHEMA).parquet(f"{base}/t"), f"{base}/t", "part", small_file_bytes=10_000, max_files=5))
    assert 2 < len(counts) < 9 and rows_of(spark, base) == rows and table is not None


def test_a_broken_run_is_completed(spark, base, tmp_path, monkeypatch):
    from stratafold.operators import maintenance

    table = lots(spark, base, small=4)
    rows = rows_of(spark, base)
    real, calls = maintenance.delete_folder, []

    def fails(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(maintenance, "delete_folder", fails)
    try:
        compact_files(table, f"{base}/t", "part", small_file_bytes=10_000)
    except OSError:
        pass
    assert len(rows_of(spark, base)) > len(rows)
    finish_compaction(spark, f"{base}/t")
    assert rows_of(spark, base) == rows
    # What was written aside but never noted goes.
    (tmp_path / "t" / COMPACTION / "lost").mkdir()
    finish_compaction(spark, f"{base}/t")
    assert not any((tmp_path / "t" / COMPACTION).iterdir()) and rows_of(spark, base) == rows


def test_plans_of_nothing(spark):
    files = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("x", "c", 3), ("x", "d", 99)], "partition string, path string, length long")
    plan = compaction_plan(files, small_file_bytes=10)
    assert sorted((r.path, r.bin, r.bin_files, r.bin_bytes) for r in plan.collect()) == [("a", 0, 2, 3), ("b", 0, 2, 3)]
    assert compaction_plan(files.filter(F.lit(False))).collect() == []
