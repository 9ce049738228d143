"""Lookups too large to broadcast: rows without a possible hit skip the shuffle."""

import pytest
from pyspark.sql import functions as F

from stratafold.operators.lookup import LookupStep, lookup_left


@pytest.fixture
def no_broadcasts(spark):
    """Only what is hinted is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def nodes(plan):
    """Every node of an executed plan."""
    yield plan
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def shuffled_rows(df):
    df.collect()
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in found)


def step(table, **options):
    return LookupStep(table, "name", "FOUND", max_rows=0, **options)


def test_rows_without_a_possible_hit_skip_the_shuffle(spark, no_broadcasts):
    rows = spark.range(20_000).select(F.col("id").alias("d0"), F.concat(F.lit("n"), "id").alias("name"))
    table = spark.range(0, 20_000, 100).select(F.concat(F.lit("n"), "id").alias("key"), F.col("id").cast("string").alias("value"))
    plain = lookup_left(rows, step(table), "found")
    filtered = lookup_left(rows, step(table, rarely_hit=True), "found")
    assert sorted(plain.collect()) == sorted(filtered.collect())
    assert shuffled_rows(plain) >= 20_000 and shuffled_rows(filtered) < 1_000


def test_nulls_repeats_odd_types_and_empty_tables(spark, no_broadcasts):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("", 3), ("z", 4)], "name string, _n long")
    table = spark.createDataFrame([("a", "A"), ("", "empty"), ("b", "B"), (None, "none")], "key string, value string")

    def both(rows, table):
        return [sorted(map(str, lookup_left(rows, step(table, rarely_hit=hit), "found").collect())) for hit in (False, True)]

    plain, filtered = both(rows, table)
    assert plain == filtered and len(plain) == 5 and sum("found=None" in r for r in plain) == 2
    for odd in (table.limit(0), table.filter("key = 'a'").withColumn("value", F.lit(None).cast("string"))):
        plain, filtered = both(rows, odd)
        assert plain == filtered
    # Keys of another type are compared by Spark's rules, which a filter of texts does not know.
    numbers = spark.createDataFrame([("01", "one")], "key string, value string")
    plain, filtered = both(spark.createDataFrame([(1,), (2,)], "name int"), numbers)
    assert plain == filtered and "found='one'" in plain[0]


def test_a_filter_beyond_its_bound_is_not_broadcast(spark, no_broadcasts):
    rows = spark.range(100).select(F.col("id").cast("string").alias("name"))
    table = rows.select(F.col("name").alias("key"), F.col("name").alias("value"))
    found = lookup_left(rows, step(table, rarely_hit=True, max_filter_bytes=1_000), "found")
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter("found = name").count() == 100
