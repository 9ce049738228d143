"""Dimensions, fact, mart and history of the entity catalogue."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratafold.operators.buckets import BucketedTable
from stratafold.operators.incremental import high_watermark, increment
from stratafold.operators.quality import Reference, Rule, run_suite
from stratafold.operators.scd2 import VALID_FROM, VALID_TO, apply_changes, closed_versions, open_versions
from stratafold.operators.star import build_fact, canonical_dimension, coverage_mart, describe_dimension
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import overwrite_partitions
from stratafold.plans import contracts as c
from stratafold.sources.files import scan_table
from stratafold.workspace import cleans_up, materialise


def dim_locations(silver: DataFrame) -> DataFrame:
    return canonical_dimension(silver, c.LOCATION_COLUMNS, "location_key", show="max").select(
        "location_key", "city", "state", "country"
    )


def dim_types(silver: DataFrame, seed: DataFrame, match: str = "canonical") -> DataFrame:
    types = canonical_dimension(silver, ["brewery_type"], "brewery_type_key", show="min")
    return describe_dimension(
        types,
        seed,
        "brewery_type",
        seed_key="brewery_type",
        seed_text="description",
        into="brewery_type_description",
        match=match,
    )


def fact(silver: DataFrame) -> DataFrame:
    return build_fact(
        silver,
        identifier="id",
        key="brewery_key",
        references={"location_key": c.LOCATION_COLUMNS, "brewery_type_key": ["brewery_type"]},
        carry=["name", "address_1", "is_active", F.lit(1).alias("quantity"), "updated_at"],
    )


def mart(fact_table: DataFrame, locations: DataFrame, rank_within: Sequence[str] = ("state",)) -> DataFrame:
    """Coverage per location, ranked by default among all places of one state name."""
    return coverage_mart(
        fact_table,
        locations,
        location_key="location_key",
        show=c.LOCATION_COLUMNS,
        rank_within=rank_within,
        names=c.COVERAGE_NAMES,
    )


def fact_table(spark: SparkSession, root: str, silver: DataFrame) -> BucketedTable:
    """The fact, in buckets by its key."""
    return BucketedTable(spark, f"{root}/fact", fact(silver).schema, ("brewery_key",), active=None, stamped=None)


def merge_facts(table: BucketedTable, rows: DataFrame, as_of: dt.datetime, references: dict[str, Reference]) -> DataFrame:
    """Upsert the rows newer than the fact's newest and return the fact.

    Only buckets that such a row falls in are read, checked and written.
    """
    fresh = materialise(increment(rows, "updated_at", high_watermark(table.read(), "updated_at"), inclusive=False), "facts")
    rules = gold_rules("fact", ["brewery_key"], list(references), list(references))
    table.merge(
        fresh,
        update=[c for c in rows.columns if c not in table.keys],
        as_of=as_of,
        audit=lambda staged: run_suite(staged, ("fact", rules), references),
    )
    return table.read()


def gold_rules(name: str, key: Sequence[str], not_null: Sequence[str] = (), references: Sequence[str] = ()) -> list[Rule]:
    """What a gold table must hold: a unique key without NULLs, further columns without, known parents."""
    rules = [Rule(f"{name}_{'_'.join(key)}_unique", "unique_count", tuple(key))]
    rules += [Rule(f"{name}_{n}_not_null", "missing_count", (n,)) for n in (*key, *not_null)]
    return rules + [Rule(column, "relationships", (column,)) for column in references]


@cleans_up
def build_gold(spark: SparkSession, silver: DataFrame, root: str, as_of: dt.datetime) -> dict[str, DataFrame]:
    """Build every gold table in order; a failed check stops those that follow."""
    seed = c.bundled_table(spark, "entity_types")
    run_suite(seed, ("seed.types", [Rule("seed_unique", "unique_count", ("brewery_type",)),
                                    Rule("seed_not_null", "missing_count", ("brewery_type",))]))
    run_suite(
        silver,
        ("staging.entities", [
            Rule("stg_id_unique", "unique_count", ("id",)),
            *[Rule(f"stg_{n}_not_null", "missing_count", (n,))
              for n in ("id", "name", "brewery_type", "city", "state", "country", "is_active")],
        ]),
    )

    def publish(name: str, df: DataFrame, key: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
        rules = gold_rules(name, key, not_null)
        table = VersionedTable(spark, f"{root}/{name}")
        return table.publish(df, as_of, audit=lambda staged: run_suite(staged, (name, rules)))

    locations = publish("dim_locations", dim_locations(silver), ["location_key"], ["city", "state", "country"])
    # A type has a description if, and only if, the seed knows it.
    types = publish("dim_types", dim_types(silver, seed), ["brewery_type_key"], ["brewery_type", "brewery_type_description"])
    facts = merge_facts(
        fact_table(spark, root, silver),
        fact(silver),
        as_of,
        {"location_key": Reference(locations, "location_key"), "brewery_type_key": Reference(types, "brewery_type_key")},
    )
    counted = [n for n in c.COVERAGE_NAMES.values() if n != c.COVERAGE_NAMES["ratio"]]
    published = publish("mart", mart(facts, locations), c.LOCATION_COLUMNS, counted)
    return {"dim_locations": locations, "dim_types": types, "fact": facts, "mart": published}


@cleans_up
def snapshot_history(spark: SparkSession, silver: DataFrame, root: str, as_of: dt.datetime) -> DataFrame:
    """Bring the type-2 history up to the current state and return it.

    Open versions are a versioned table; closed ones are written once, under the
    number of the open version they belong to.  Repeating a run that failed
    half-way replaces that number's rows, and readers ignore them until the open
    version is published.
    """
    opened = VersionedTable(spark, f"{root}/open")
    current = opened.read()
    if current is None:
        now = F.col("updated_at")
        current = spark.createDataFrame([], silver.select("*", now.alias(VALID_FROM), now.alias(VALID_TO)).schema)
    changed = materialise(apply_changes(current, silver, ["id"], "updated_at", ["ingestion_date"]), "history")
    batch = F.lit(opened.number() + 1).cast("bigint").alias("closed_batch")
    overwrite_partitions(closed_versions(changed).select("*", batch), f"{root}/closed", ["closed_batch"])
    # Older closed versions end where these begin, so these are all that can repeat a key and time.
    rules = ("history", HISTORY_RULES)
    opened.publish(open_versions(changed), as_of, audit=lambda staged: run_suite(changed, rules))
    return read_history(spark, root)


# What a history must hold.
HISTORY_RULES = [
    Rule("history_version_unique", "unique_count", ("id", VALID_FROM)),
    Rule("history_id_not_null", "missing_count", ("id",)),
    Rule("history_valid_from_not_null", "missing_count", (VALID_FROM,)),
]


def _with_closed(spark: SparkSession, current: DataFrame, root: str, number: int) -> DataFrame:
    """Open versions and the closed ones that belong to their number or one before."""
    stored = StructType([*current.schema.fields, StructField("closed_batch", LongType())])
    closed = scan_table(spark, f"{root}/closed", stored)
    if closed is None:
        return current
    return closed.filter(F.col("closed_batch") <= number).select(*current.columns).unionByName(current)


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    """Closed and open versions as of the last published run."""
    opened = VersionedTable(spark, f"{root}/open")
    current = opened.read()
    if current is None:
        return None
    return _with_closed(spark, current, root, opened.number())
