import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratafold.operators.quality import Rule, evaluate
from stratafold.operators.scd2 import apply_changes, as_of, closed_versions, open_versions, version_intervals
from tests.test_rows import skewed

START = dt.datetime(2026, 1, 1)


def brute_force(data):
    """(key, from) -> (row id, to) of (id, key, time, value) rows."""
    last = {}
    for i, k, ts, _ in data:
        last[k, ts] = max(i, last.get((k, ts), -1))
    times = {}
    for k, ts in last:
        times.setdefault(k, []).append(ts)
    out = {}
    for k, ts_list in times.items():
        ts_list.sort()
        for ts, following in zip(ts_list, [*ts_list[1:], None]):
            out[k, ts] = (last[k, ts], following)
    return out


def as_dict(df):
    rows = df.collect()
    found = {(r.k, r.valid_from): (r.id, r.valid_to) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("ranges", [None, 1, 3, 50])
def test_intervals_equal_brute_force_however_cut(spark, ranges):
    data, df = skewed(spark)
    assert as_dict(version_intervals(df, ["k"], "ts", ["id"], ranges=ranges)) == brute_force(data)


@pytest.mark.parametrize("ranges", [None, 6])
def test_a_burst_of_one_key_is_spread(spark, ranges):
    burst = [(i, 1, START + dt.timedelta(seconds=i // 7), 0) for i in range(420)]
    data = burst + [(1000 + i, 1 + i % 3, START + dt.timedelta(days=i), 0) for i in range(30)]
    df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long")
    assert as_dict(version_intervals(df, ["k"], "ts", ["id"], ranges=ranges)) == brute_force(data)
    cut = df.repartitionByRange(6, "k", "ts", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in cut.collect()) < 150


@pytest.mark.parametrize("row", [(1, None, START), (1, 1, None)])
def test_null_key_or_time_is_refused(spark, row):
    df = spark.createDataFrame([row, (2, 2, START)], "id long, k long, ts timestamp_ntz")
    with pytest.raises(Exception, match="NULL among k, ts"):
        version_intervals(df, ["k"], "ts", ["id"]).collect()


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_other_time_types(spark, kind):
    rows = [(i, i % 3, START + dt.timedelta(days=i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz").withColumn("ts", F.col("ts").cast(kind))
    plain = version_intervals(df, ["k"], "ts", ["id"])
    sliced = version_intervals(df, ["k"], "ts", ["id"], ranges=4)
    assert as_dict(plain) == as_dict(sliced)
    assert sum(r.valid_to is None for r in sliced.collect()) == 3


@pytest.mark.parametrize("batches", [2, 5])
def test_incremental_equals_rebuild(spark, batches):
    data, df = skewed(spark, 800)
    data.sort(key=lambda r: (r[2], r[0]))
    edges = [START + dt.timedelta(minutes=2000 * b / batches) for b in range(batches + 1)]
    closed = []
    current = version_intervals(df.limit(0), ["k"], "ts", ["id"])
    for low, high in zip(edges, edges[1:]):
        batch = df.filter((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz")))
        rows = apply_changes(current, batch, ["k"], "ts", ["id"]).collect()
        changed = spark.createDataFrame(rows, current.schema)
        closed += closed_versions(changed).collect()
        current = spark.createDataFrame(open_versions(changed).collect(), current.schema)
    whole = current.union(spark.createDataFrame(closed, current.schema))
    assert as_dict(whole) == brute_force(data)


def versions(spark, rows):
    return version_intervals(spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz"), ["k"], "ts", ["id"])


def day(n):
    return START + dt.timedelta(days=n)


def test_late_and_repeated_changes_are_ignored(spark):
    current = open_versions(versions(spark, [(1, 1, day(5)), (2, 2, day(5))]))
    batch = spark.createDataFrame([(3, 1, day(4)), (4, 1, day(5))], "id long, k long, ts timestamp_ntz")
    rows = apply_changes(current, batch, ["k"], "ts", ["id"])
    assert as_dict(rows) == {(1, day(5)): (1, None), (2, day(5)): (2, None)}


def test_point_in_time(spark):
    history = versions(spark, [(1, 1, day(1)), (2, 1, day(3)), (3, 2, day(2))])

    def at(n):
        return sorted(r.id for r in as_of(history, F.lit(day(n)).cast("timestamp_ntz")).collect())

    assert [at(n) for n in (0, 1, 2, 3, 9)] == [[], [1], [1, 3], [2, 3], [2, 3]]


def test_versions_are_unique(spark):
    _, df = skewed(spark)
    history = version_intervals(df, ["k"], "ts", ["id"])
    assert evaluate(history, [Rule("u", "unique_count", ("k", "valid_from"))]).first().passed
