from pyspark.sql import functions as F

from stratafold.operators.star import canonical_dimension, describe_dimension
from stratafold.plans import gold
from tests.conftest import plan_of

SCHEMA = "id string, name string, brewery_type string, address_1 string, city string, state string, country string, is_active boolean, updated_at timestamp"


def silver(spark):
    rows = [
        ("1", "a", "micro", "x", "Wien", "Vienna", "Austria", True),
        ("2", "b", " Micro", "x", " wien", "VIENNA", "austria", True),
        ("3", "c", "MICRO", "x", "Graz", "Vienna", "Austria", False),
        ("4", "d", "cave", "x", "Wien", "Vienna", "Germany", True),
        ("5", "e", None, "x", None, None, None, False),
    ]
    return spark.createDataFrame([(*r, None) for r in rows], SCHEMA)


def test_locations_merge_spellings(spark):
    rows = gold.dim_locations(silver(spark)).collect()
    assert sorted((r.country, r.state, r.city) for r in rows) == [
        ("", "", ""), ("Austria", "Vienna", "Graz"), ("Germany", "Vienna", "Wien"), ("austria", "Vienna", "wien")
    ]
    assert len({r.location_key for r in rows}) == 4


def test_spellings_are_hashed_before_they_are_sorted(spark, base):
    silver(spark).write.parquet(f"{base}/t")
    plan = plan_of(gold.dim_locations(spark.read.parquet(f"{base}/t")))
    below = plan[plan.rindex("REPARTITION_BY_COL"):]
    assert "HashAggregate" in below and "Sort" not in below


def test_types_show_the_least_spelling_and_match_the_seed_anyhow(spark):
    seed = spark.createDataFrame([("micro", "small")], "brewery_type string, description string")
    rows = {r.brewery_type: r.brewery_type_description for r in gold.dim_types(silver(spark), seed).collect()}
    assert rows == {"MICRO": "small", "cave": None, "": None}
    exact = {r.brewery_type: r.brewery_type_description for r in gold.dim_types(silver(spark), seed, "exact").collect()}
    assert exact["MICRO"] is None


def test_describe_keeps_unmatched(spark):
    dim = canonical_dimension(silver(spark), ["country"], "k", show="min")
    empty = spark.createDataFrame([], "c string, d string")
    assert describe_dimension(dim, empty, "country", seed_key="c", seed_text="d", into="text").count() == dim.count()


def test_fact_needs_no_shuffle(spark):
    fact = gold.fact(silver(spark))
    assert fact.count() == 5 and "Exchange" not in plan_of(fact)
    assert fact.filter(F.col("location_key").isNull()).count() == 0
    assert fact.columns[:3] == ["brewery_key", "location_key", "brewery_type_key"]
    no_id = gold.fact(silver(spark).withColumn("id", F.lit(None).cast("string")))
    assert no_id.filter("brewery_key IS NULL").count() == 5


def test_mart(spark):
    s = silver(spark)
    rows = {(r.country, r.city): r for r in gold.mart(gold.fact(s), gold.dim_locations(s)).collect()}
    vienna = rows["austria", "wien"]
    assert (vienna.active_breweries_count, vienna.inactive_breweries_count, vienna.total_breweries) == (2, 0, 2)
    # One state name in two countries is one ranking.
    assert [rows[k].city_state_rank for k in (("austria", "wien"), ("Germany", "Wien"), ("Austria", "Graz"))] == [1, 2, 3]
    assert rows["Austria", "Graz"].active_ratio == 0.0 and vienna.active_ratio == 100.0
    assert sum(r.total_breweries for r in rows.values()) == 5
    within = gold.mart(gold.fact(s), gold.dim_locations(s), ["country", "state"]).collect()
    assert {r.city: r.city_state_rank for r in within if r.country == "Germany"} == {"Wien": 1}
