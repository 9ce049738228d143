"""Metrics and key registers: equal to a check of the whole table, from changed partitions only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratafold.operators.metrics import PartitionMetrics
from stratafold.operators.quality import Rule, evaluate
from stratafold.operators.uniqueness import KeyRegister, changed_parts
from stratafold.operators.writers import overwrite_partitions
from tests.conftest import plan_of

DAY = dt.datetime(2026, 1, 1)
SCHEMA = "k string, n long, place string, day string"
UNIQUE = [Rule("k", "unique_count", ("k",))]


class Stored:
    """A partitioned table whose partitions can be replaced."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def put(self, rows):
        df = rows if not isinstance(rows, list) else self.spark.createDataFrame(rows, SCHEMA)
        overwrite_partitions(df, self.path, ["day"])

    def read(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return self.spark.read.schema(schema).parquet(self.path)

    def days(self, *names):
        return self.spark.createDataFrame([(n,) for n in names], "day string")


@pytest.fixture
def stored(spark, base):
    return Stored(spark, f"{base}/table")


def agrees(register, table, columns=("k",)):
    rule = Rule("k", "unique_count", columns)
    whole = evaluate(table, [rule]).first()
    kept = register.repeats().first()
    assert kept["_duplicates"] == whole["actual"]
    assert kept["_rows"] == table.dropna(subset=list(columns)).count()
    return kept["_duplicates"]


def test_repeats_within_and_across_partitions(spark, base, stored):
    register = KeyRegister(spark, f"{base}/keys", ("k",), "day", places=4)
    stored.put([("a", 1, "x", "1"), ("b", 1, "x", "1"), ("b", 2, "x", "1"), (None, 1, "x", "1"), (None, 2, "x", "1")])
    register.refresh(stored.read(), stored.days("1"), DAY)
    assert agrees(register, stored.read()) == 1

    stored.put([("c", 1, "x", "2"), ("a", 1, "x", "2"), ("", 1, "x", "2"), ("e", 1, "x", "3"), ("c", 1, "x", "3")])
    found = register.refresh(stored.read(), stored.days("2", "3"), DAY)
    assert agrees(register, stored.read()) == 3 and found["met"] == 1
    assert register.clashes().count() == 4

    # A partition that is replaced takes its part in repeats back, and brings new ones.
    stored.put([("z", 1, "x", "1"), ("e", 1, "x", "1"), ("b", 1, "x", "1")])
    register.refresh(stored.read(), stored.days("1"), DAY)
    assert agrees(register, stored.read()) == 2

    # The same again changes nothing; a key its partition held before is not looked up.
    found = register.refresh(stored.read(), stored.days("1", "2"), DAY)
    assert agrees(register, stored.read()) == 2 and found["fresh"] == 0

    # A partition without rows goes.
    gone = stored.read().filter("day <> '3'")
    register.refresh(gone, stored.days("3"), DAY)
    assert agrees(register, gone) == 0 and {r.part for r in register.parts().collect()} == {"1", "2"}
    assert register.clashes().count() == 0
    assert register.tidy() > 0
    register.refresh(stored.read(), stored.days("3"), DAY)
    assert agrees(register, stored.read()) == 2


def test_null_and_empty_partitions_are_one_and_keys_may_have_columns(spark, base, stored):
    register = KeyRegister(spark, f"{base}/keys", ("k", "n"), "day", places=2)
    stored.put([("a", 1, "x", None), ("ab", 1, "x", ""), ("a", None, "x", "1"), ("a", 1, "x", "1"), ("a", 2, "x", "1")])
    register.refresh(stored.read(), stored.days(None, "1"), DAY)
    assert agrees(register, stored.read(), ("k", "n")) == 1
    register.refresh(stored.read(), stored.days(""), DAY)
    assert agrees(register, stored.read(), ("k", "n")) == 1
    assert register.parts().count() == 2


def test_empty_table(spark, base, stored):
    register = KeyRegister(spark, f"{base}/keys", ("k",), "day")
    empty = spark.createDataFrame([], SCHEMA)
    assert register.repeats().first().asDict() == {"_rows": 0, "_duplicates": 0}
    register.refresh(empty, stored.days("1"), DAY)
    assert register.repeats().first().asDict() == {"_rows": 0, "_duplicates": 0}


def numbered(spark, start, end, day):
    return spark.range(start, end).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"), F.lit("x").alias("place"), F.lit(day).alias("day"))


def test_false_positives_are_looked_up_and_found_false(spark, base, stored):
    """A filter of half a bit per key lets nearly everything through; the exact lookup decides."""
    loose = KeyRegister(spark, f"{base}/loose", ("k",), "day", bits_per_key=0, places=4)
    tight = KeyRegister(spark, f"{base}/tight", ("k",), "day", places=4)
    stored.put(numbered(spark, 0, 60_000, "1").union(numbered(spark, 200_000, 200_010, "2")))
    for register in (loose, tight):
        register.refresh(stored.read(), stored.days("1", "2"), DAY)
    stored.put(numbered(spark, 59_990, 62_000, "3"))
    found = loose.refresh(stored.read(), stored.days("3"), DAY)
    assert found["possible"] > 1_900 and found["met"] == 10
    assert agrees(loose, stored.read()) == 10
    found = tight.refresh(stored.read(), stored.days("3"), DAY)
    assert 10 <= found["possible"] < 20 and found["met"] == 10
    assert agrees(tight, stored.read()) == 10


def test_a_filter_grows_with_its_keys(spark, base, stored):
    register = KeyRegister(spark, f"{base}/keys", ("k",), "day", places=4)
    for number in range(4):
        start = (1 << number) * 1_000
        stored.put(numbered(spark, start, 2 * start, str(number)))
        register.refresh(stored.read(), stored.days(str(number)), DAY)
        assert agrees(register, stored.read()) == 0
    # 15,000 keys of 32 bits take 15 blocks of 32,768.
    assert register._of("filter", 3, "block long, bitmap binary, blocks long").select("blocks").first()[0] == 16


def test_a_refresh_that_breaks_off_leaves_the_version_before(spark, base, stored, monkeypatch):
    register = KeyRegister(spark, f"{base}/keys", ("k",), "day", places=2)
    stored.put([("a", 1, "x", "1"), ("b", 1, "x", "2")])
    register.refresh(stored.read(), stored.days("1", "2"), DAY)
    stored.put([("a", 1, "x", "2")])
    with monkeypatch.context() as patch:
        patch.setattr(KeyRegister, "_write_filter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            register.refresh(stored.read(), stored.days("2"), DAY)
    assert register.repeats().first()["_duplicates"] == 0
    register.refresh(stored.read(), stored.days("2"), DAY)
    assert agrees(register, stored.read()) == 1


RULES = [
    Rule("rows", "row_count", limit=3),
    Rule("k", "missing_count", ("k",)),
    Rule("n", "missing_percent", ("n",), 10.0, "warn"),
    Rule("odd", "no_such_rule"),
]


def test_metrics_equal_a_check_of_the_whole_table(spark, base, stored):
    stored.put([("a", 1, "x", "1"), ("b", None, "x", "1"), (None, 7, "x", None)])
    metrics = PartitionMetrics.of(stored.read(), f"{base}/metrics", "day", ["k", "n"])
    assert metrics.evaluate(RULES).collect() == evaluate(stored.read().limit(0), RULES).collect()
    metrics.refresh(stored.read(), stored.days("1", None), DAY)
    assert metrics.evaluate(RULES).collect() == evaluate(stored.read(), RULES).collect()
    stored.put([("a", 5, "x", "2"), ("c", None, "x", "1"), ("d", 3, "x", "1")])
    metrics.refresh(stored.read(), stored.days("1", "2"), DAY)
    assert metrics.evaluate(RULES).collect() == evaluate(stored.read(), RULES).collect()
    profile = {r["column"]: r.asDict() for r in metrics.profile().collect()}
    assert profile["n"] == {"column": "n", "rows": 4, "nulls": 1, "least": "3", "greatest": "7", "about_distinct": 3}
    assert profile["k"]["least"] == "a" and profile["k"]["about_distinct"] == 3
    metrics.refresh(stored.read().filter("day = '2'"), stored.days("1", ""), DAY)
    assert metrics.counts(["k"]).first().asDict() == {"_rows": 1, "_missing_0": 0}
    with pytest.raises(ValueError, match="needs a register"):
        metrics.evaluate(UNIQUE)
    with pytest.raises(ValueError, match="no metrics of column"):
        metrics.evaluate([Rule("p", "missing_count", ("place",))])


def test_a_refresh_lists_the_changed_partition_only(spark, base, stored):
    stored.put([("a", 1, "x", "1"), ("b", 1, "x", "2"), ("c", 1, "x", "3")])
    metrics = PartitionMetrics.of(stored.read(), f"{base}/metrics", "day", ["n"])
    rows, _ = changed_parts(stored.read(), stored.days("2"), "day")
    measured = metrics.measured(rows)
    assert "ReadSchema: struct<n:bigint>" in plan_of(measured)
    measured.collect()
    scan = next(s for s in leaves(measured._jdf.queryExecution().executedPlan()) if "FileScan" in s.toString())
    assert scan.metrics().apply("numPartitions").value() == 1 and scan.metrics().apply("numFiles").value() == 1


def leaves(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found = plan.collectLeaves()
    for i in range(found.size()):
        leaf = found.apply(i)
        if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            yield from leaves(leaf.plan())
        else:
            yield leaf
