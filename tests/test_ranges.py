"""Keys that hold very many rows: histories, point-in-time joins and ranks, however they are cut."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratafold.operators.ranges import cut_into_ranges, spanning_keys
from stratafold.operators.ranking import dense_rank_cut, dense_rank_within
from stratafold.operators.scd2 import as_of_join, frequent_keys, version_intervals
from tests.conftest import plan_of
from tests.test_scd2 import as_dict, brute_force

START = dt.datetime(2026, 1, 1)


def minute(n):
    return START + dt.timedelta(minutes=n)


def changes(seed=1):
    """Of 600 changes half belong to key 1."""
    random.seed(seed)
    data = [(i, 1 if i % 2 else random.randrange(2, 60), minute(random.randrange(900)), i) for i in range(600)]
    return data


def test_frequent_keys_are_cut_and_all_others_not(spark):
    data = changes()
    df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long").repartition(5)
    hash_of_1 = spark.range(1).select(F.xxhash64(F.lit(1).cast("long"))).first()[0]
    assert frequent_keys(df, ["k"], 100) == [hash_of_1] and frequent_keys(df, ["k"], 301) == []
    assert frequent_keys(df.limit(0), ["k"], 1) == []
    for hot in (1, 8, 100, 10**6):
        assert as_dict(version_intervals(df, ["k"], "ts", ["id"], hot_rows=hot)) == brute_force(data)
    plain = plan_of(version_intervals(df, ["k"], "ts", ["id"]))
    assert plain.count("hashpartitioning") == 1 and "rangepartitioning" not in plain
    assert version_intervals(df.limit(0), ["k"], "ts", ["id"]).collect() == []


def test_only_keys_at_the_ends_span_ranges(spark):
    df = spark.createDataFrame([(k, i) for k in range(30) for i in range(1 if k != 11 else 200)], "k long, i long")
    ranged = cut_into_ranges(df, [F.col("k"), F.col("i")], 6)
    assert [r._k_k for r in spanning_keys(ranged, ["k"]).collect()] == [11]


@pytest.mark.parametrize("ranges", [None, 1, 9])
def test_points_meet_the_version_of_their_instant(spark, ranges):
    data = changes(2)
    history = version_intervals(spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long"), ["k"], "ts", ["id"]).drop("ts")
    # One key has neither versions before nor after a gap: those that end are not followed by another.
    closed = history.withColumn("valid_to", F.when((F.col("k") == 5) & F.col("valid_to").isNull(), F.lit(minute(950)).cast("timestamp_ntz")).otherwise(F.col("valid_to")))
    versions = closed.collect()
    points = [(p, 1 if p % 2 else random.randrange(0, 62), minute(random.randrange(-50, 1000))) for p in range(500)]
    points += [(500, 1, None), (501, None, minute(5)), (502, 1, versions[0].valid_from), (500, 1, None)]
    asked = spark.createDataFrame(points, "point long, k long, at timestamp_ntz")
    want = []
    for p, k, at in points:
        hit = [v for v in versions if v.k == k and at is not None and v.valid_from <= at and (v.valid_to is None or v.valid_to > at)]
        assert len(hit) <= 1
        want.append((p, k, at, *((hit[0].id, hit[0].v, hit[0].valid_from, hit[0].valid_to) if hit else (None,) * 4)))
    got = as_of_join(asked, closed, ["k"], "at", ranges=ranges)
    assert got.columns == ["point", "k", "at", "id", "v", "valid_from", "valid_to"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_points_without_versions_and_versions_without_points(spark):
    history = spark.createDataFrame([], "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    points = spark.createDataFrame([(1, minute(3))], "k long, at timestamp_ntz")
    assert [tuple(r) for r in as_of_join(points, history, ["k"], "at").collect()] == [(1, minute(3), None, None, None)]
    assert as_of_join(points.limit(0), history, ["k"], "at").collect() == []
    with pytest.raises(ValueError, match="both sides have"):
        as_of_join(points.withColumn("v", F.lit(1)), history, ["k"], "at")


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_cut_ranks_equal_those_of_a_window(spark, ranges):
    random.seed(3)
    rows = [(i, random.choice(["a", "a", "a", None, "b"]), random.choice([None, *range(90)]), "x") for i in range(900)] + [(1000, "c", None, "x")]
    df = spark.createDataFrame(rows, "i long, g string, m long, h string")
    got = dense_rank_cut(df, ["g", "h"], "m", "rank", ranges=ranges)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, dense_rank_within(df, ["g", "h"], "m", "rank").collect()), key=str)
