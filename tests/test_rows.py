"""Deduplication, quarantine, increments, lookups, ranks, joins, writers."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratafold.operators.dedup import latest_per_key, latest_per_key_agg
from stratafold.operators.incremental import high_watermark, increment
from stratafold.operators.joins import broadcast_if_small, missing_references
from stratafold.operators.lookup import LookupStep, coverage, lookup_cascade, prepare_lookup
from stratafold.operators.quarantine import NULL_ID, count_invalid, quarantine_rows, split_invalid, write_quarantine
from stratafold.operators.ranking import dense_rank_within
from stratafold.operators.writers import overwrite_partitions, replace_table
from stratafold.plans.contracts import bundled_table
from stratafold.plans.matches import add_stadium_state, derive_match_columns
from tests.conftest import plan_of


def skewed(spark, rows=3000, seed=5):
    """A third of the rows share one key, some times repeat."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        key = 0 if rng.random() < 0.34 else rng.randrange(1, 200)
        data.append((i, key, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randrange(2000)), rng.choice("abc")))
    return data, spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v string")


def test_latest_per_key_both_forms_and_brute_force(spark):
    data, df = skewed(spark)
    best = {}
    for row in data:
        if row[1] not in best or (row[2], row[0]) > (best[row[1]][2], best[row[1]][0]):
            best[row[1]] = row
    want = sorted(best.values())
    for form in (latest_per_key, latest_per_key_agg):
        got = form(df.repartition(6), ["k"], "ts", ["id"])
        assert got.columns == df.columns
        assert sorted(tuple(r) for r in got.collect()) == want


def test_latest_per_key_reduces_before_the_shuffle(spark):
    _, df = skewed(spark, 10)
    plan = plan_of(latest_per_key(df, ["k"], "ts", ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("Exchange")[1]


def test_latest_per_key_wants_ties(spark):
    _, df = skewed(spark, 10)
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], "ts", [])


def test_split_is_a_partition_of_the_input(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None), (None, None)], "id string, n int")
    good, bad = split_invalid(df, [(NULL_ID, F.col("id").isNull()), ("SMALL", F.col("n") < 2), ("NO_N", F.col("n").isNull())])
    assert sorted(r.quarantine_reason for r in bad.collect()) == ["NO_N", "NULL_ID", "NULL_ID", "SMALL"]
    assert good.count() == 0
    good, bad = split_invalid(df, [("SMALL", F.col("n") < 2)])
    assert good.count() == 3 and bad.count() == 1


def test_invalid_rows_are_counted_once(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, None)], "id string, n int")
    rules = [(NULL_ID, F.col("id").isNull()), ("SMALL", F.col("n") < 1)]
    assert count_invalid(df, rules) == (3, 2)
    assert count_invalid(df.limit(0), rules) == (0, 0)


def test_quarantine_is_appended_again_on_a_rerun(spark, base):
    df = spark.createDataFrame([(None, "x")], "id string, name string")
    _, bad = split_invalid(df, [(NULL_ID, F.col("id").isNull())])
    rows = quarantine_rows(bad, ["id", "name"], "2026-01-15", dt.datetime(2026, 1, 15, 6))
    for _ in range(2):
        write_quarantine(rows, f"{base}/q")
    stored = spark.read.parquet(f"{base}/q")
    assert stored.count() == 2 and stored.first().quarantine_reason == "NULL_ID"
    write_quarantine(rows, f"{base}/q", replace=True)
    assert spark.read.parquet(f"{base}/q").count() == 1


def test_null_check_reaches_the_scan(spark, base):
    spark.createDataFrame([("a",), (None,)], "id string").write.parquet(f"{base}/t")
    _, bad = split_invalid(spark.read.parquet(f"{base}/t"), [(NULL_ID, F.col("id").isNull())])
    assert "PushedFilters: [IsNull(id)]" in plan_of(bad)


def test_increments(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("2026-01-03",)], "d string")
    assert high_watermark(None, "d") is None
    assert high_watermark(df.limit(0), "d") is None
    assert high_watermark(df, "d") == "2026-01-03"
    assert increment(df, "d", "2026-01-02").count() == 2
    assert increment(df, "d", "2026-01-02", inclusive=False).count() == 1
    assert increment(df, "d", None, inclusive=False).count() == 3
    assert increment(df, "d", "2026-01-02", full_refresh=True).count() == 3


MATCHES = [
    ("match-001", "Flamengo", "Maracanã", 2, 1, "2026-05-25", "16:00"),
    ("match-002", "Cuiabá", "Estádio Imaginário", 0, 0, "2026-05-25", "18:30"),
    ("match-003", "TimeXPTO", "Estádio Desconhecido", 1, 3, "2026-05-26", ""),
    ("match-004", "Grêmio", "Arena do Grêmio", 1, 1, "2026-05-26", "20:00"),
    ("match-005", "Vitória", "Barradao", 1, 1, "2026-05-26", "20:00"),
    ("match-006", None, None, 1, 1, "2026-05-26", "20:00"),
]


def matches(spark):
    schema = "ge_match_id string, home_team string, stadium string, score_home int, score_away int, date string, kickoff_time string"
    return spark.createDataFrame(MATCHES, schema).withColumn("away_team", F.lit("Atlético-MG"))


def test_stadium_cascade_keeps_the_row_count(spark):
    rows = {r.ge_match_id: r for r in add_stadium_state(derive_match_columns(matches(spark))).collect()}
    assert len(rows) == len(MATCHES)
    state = {k: (r.stadium_state, r.stadium_state_origin) for k, r in rows.items()}
    assert state["match-001"] == ("RJ", "STADIUM_LOOKUP")
    assert state["match-002"] == ("MT", "HOME_TEAM_FALLBACK")
    assert state["match-003"] == ("UNKNOWN", "UNKNOWN")
    assert state["match-004"] == ("RS", "STADIUM_LOOKUP")
    assert state["match-005"] == ("BA", "STADIUM_LOOKUP")
    assert state["match-006"] == ("UNKNOWN", "UNKNOWN")
    assert (rows["match-001"].stadium, rows["match-001"].away_team) == ("Maracana", "Atletico-MG")
    assert rows["match-003"].kickoff_ts is None and rows["match-001"].kickoff_ts.hour == 16
    assert (rows["match-003"].match_outcome, rows["match-003"].total_goals) == ("AWAY_WIN", 4)
    assert not [c for c in add_stadium_state(matches(spark)).columns if c.startswith("_")]


def test_bundled_lookups_merge_spellings(spark):
    stadiums = prepare_lookup(bundled_table(spark, "stadium_states"), "stadium", "state")
    teams = prepare_lookup(bundled_table(spark, "home_team_states"), "home_team", "state")
    assert (stadiums.count(), teams.count()) == (108, 120)
    states = set(r.value for r in stadiums.union(teams).collect())
    assert all(len(s) == 2 and s.isupper() for s in states)


def test_conflicting_lookup_fails(spark):
    table = spark.createDataFrame([("Canindé", "SP"), ("Caninde", "RJ")], "key string, value string")
    with pytest.raises(PySparkException, match="several values"):
        prepare_lookup(table).collect()


def test_lookup_is_the_same_with_and_without_broadcast(spark):
    table = prepare_lookup(spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string"))
    df = spark.createDataFrame([("a",)] * 50 + [("b",), ("z",), (None,)], "k string")
    step = [LookupStep(table, "k", "HIT")]
    names = {"value_column": "v", "origin_column": "o"}
    hinted = lookup_cascade(df, step, **names)
    assert "BroadcastHashJoin" in plan_of(hinted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = lookup_cascade(df, [LookupStep(table, "k", "HIT", max_rows=1)], **names)
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, hinted.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.o: r.rows for r in coverage(hinted, "o").collect()} == {"HIT": 51, "UNKNOWN": 2}


def test_broadcast_needs_both_bounds(spark):
    wide = spark.createDataFrame([("x" * 1000,)] * 10, "t string")
    assert "ResolvedHint" in broadcast_if_small(wide)._jdf.queryExecution().analyzed().toString()
    for bound in ({"max_rows": 9}, {"max_bytes": 9_999}):
        assert "ResolvedHint" not in broadcast_if_small(wide, **bound)._jdf.queryExecution().analyzed().toString()


def test_missing_references(spark):
    child = spark.createDataFrame([(1,)] * 30 + [(2,), (None,), (3,)], "fk int")
    parent = spark.createDataFrame([(2,), (2,)], "pk int")
    found = {r.reference: r.rows for r in missing_references(child, parent, "fk", "pk").collect()}
    assert found == {1: 30, 3: 1}


def test_dense_rank_within_large_and_null_groups(spark):
    rng = random.Random(3)
    data = [(rng.choice(["s", "s", None, "t"]), rng.randrange(8), i) for i in range(400)]
    df = spark.createDataFrame(data, "g string, m long, i int")
    got = {r.i: r.rank for r in dense_rank_within(df, ["g"], "m", "rank").collect()}
    assert len(got) == 400
    for g, m, i in data:
        assert got[i] == 1 + len({m2 for g2, m2, _ in data if g2 == g and m2 > m})


def test_overwrite_replaces_only_the_partitions_present(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "n int, p string")
    overwrite_partitions(first, path, ["p"])
    untouched = sorted(f.name for f in Path(tmp_path, "t", "p=a").iterdir())
    for _ in range(2):
        overwrite_partitions(spark.createDataFrame([(9, "b")], "n int, p string"), path, ["p"])
    assert sorted((r.n, r.p) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]
    assert sorted(f.name for f in Path(tmp_path, "t", "p=a").iterdir()) == untouched


def test_partitions_are_packed_when_written(spark, tmp_path):
    df = spark.range(1000).withColumn("p", (F.col("id") > 500).cast("string")).repartition(16)
    replace_table(df, f"file://{tmp_path}/t", ["p"])
    for part in Path(tmp_path, "t").glob("p=*"):
        assert len(list(part.glob("*.parquet"))) == 1
