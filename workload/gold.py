"""Star schema and data quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratafold.functions.temporal import ntz as instant
from stratafold.operators.joins import missing_references
from stratafold.operators.metrics import PartitionMetrics
from stratafold.operators.quality import (
    Reference,
    Rule,
    evaluate,
    freshness,
    null_count_frame,
    summary_frame,
)
from stratafold.operators.star import build_fact, canonical_dimension, coverage_mart, describe_dimension
from stratafold.operators.uniqueness import KeyRegister
from stratafold.operators.writers import overwrite_partitions
from stratafold.plans.gold import gold_rules
from stratafold.workspace import fresh_path
from workload.proxies import ENTITY_SQL, entities
from workload.registry import query, table

LOCATION = ["country", "state", "city"]

RUN = dt.datetime(2024, 2, 1)

STAR_SQL = f"""
{ENTITY_SQL},
dim_loc AS (
  SELECT md5(cu || '|' || su || '|' || tu) AS location_key, city, state, country FROM (
    SELECT upper(trim(coalesce(country, ''))) AS cu, upper(trim(coalesce(state, ''))) AS su,
           upper(trim(coalesce(city, ''))) AS tu, max(trim(coalesce(country, ''))) AS country,
           max(trim(coalesce(state, ''))) AS state, max(trim(coalesce(city, ''))) AS city
    FROM ent GROUP BY 1, 2, 3)
),
dim_type AS (
  SELECT md5(upper(trim(etype))) AS type_key, etype FROM (
    SELECT min(trim(coalesce(etype, ''))) AS etype FROM ent GROUP BY upper(trim(coalesce(etype, ''))))
),
fact AS (
  SELECT md5(upper(trim(id))) AS entity_key,
         md5(upper(trim(coalesce(country, ''))) || '|' || upper(trim(coalesce(state, ''))) || '|' ||
             upper(trim(coalesce(city, '')))) AS location_key,
         md5(upper(trim(coalesce(etype, '')))) AS type_key,
         id AS id_business, name, is_active, 1 AS quantity, updated_at
  FROM ent
)"""


def dim_locations(ent):
    return canonical_dimension(ent, LOCATION, "location_key", show="max")


def fact(ent):
    return build_fact(
        ent,
        identifier="id",
        key="entity_key",
        references={"location_key": LOCATION, "type_key": ["etype"]},
        carry=["name", "is_active", F.lit(1).alias("quantity"), "updated_at"],
    )


@query("dim_locations", f"WITH {STAR_SQL} SELECT location_key, city, state, country FROM dim_loc")
def dim_locations_query(spark, sf_dir):
    return dim_locations(entities(spark, sf_dir))


@query(
    "dim_types",
    f"""
WITH {STAR_SQL}
SELECT type_key, etype, CASE WHEN upper(etype) <> 'FURNITURE' THEN 'about ' || upper(etype) END AS type_description
FROM dim_type""",
)
def dim_types_query(spark, sf_dir):
    """The seed describes every market segment but one."""
    ent = entities(spark, sf_dir)
    segments = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("etype")).distinct()
    seed = segments.filter(F.col("etype") != "furniture").withColumn(
        "description", F.concat(F.lit("about "), F.upper("etype"))
    )
    types = canonical_dimension(ent, ["etype"], "type_key", show="min")
    return describe_dimension(
        types, seed, "etype", seed_key="etype", seed_text="description", into="type_description"
    )


@query("fact_build", f"WITH {STAR_SQL} SELECT * FROM fact")
def fact_build_query(spark, sf_dir):
    return fact(entities(spark, sf_dir))


@query(
    "coverage_mart",
    f"""
WITH {STAR_SQL},
agg AS (
  SELECT country, state, city, CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS active_count,
         CAST(sum(CASE WHEN NOT is_active THEN 1 ELSE 0 END) AS BIGINT) AS inactive_count, count(*) AS total_count
  FROM fact JOIN dim_loc USING (location_key) GROUP BY 1, 2, 3
)
SELECT country, state, city, active_count, inactive_count, total_count,
       CAST(round(active_count * 100.0 / nullif(total_count, 0), 2) AS DOUBLE) AS active_ratio,
       dense_rank() OVER (PARTITION BY state ORDER BY active_count DESC) AS city_state_rank
FROM agg""",
)
def coverage_mart_query(spark, sf_dir):
    ent = entities(spark, sf_dir)
    return coverage_mart(
        fact(ent),
        dim_locations(ent),
        location_key="location_key",
        show=LOCATION,
        rank_within=["state"],
        names={
            "active": "active_count",
            "inactive": "inactive_count",
            "total": "total_count",
            "ratio": "active_ratio",
            "rank": "city_state_rank",
        },
    )


# --- data quality ------------------------------------------------------------


@query(
    "null_counts",
    f"""
WITH {ENTITY_SQL}
SELECT 'id' AS "column", count(*) - count(id) AS nulls FROM ent
UNION ALL SELECT 'state', count(*) - count(state) FROM ent
UNION ALL SELECT 'name', count(*) - count(name) FROM ent""",
)
def null_counts_query(spark, sf_dir):
    return null_count_frame(entities(spark, sf_dir), ["id", "state", "name"])


@query(
    "quality_summary",
    f"""
WITH {ENTITY_SQL}
SELECT count(*) AS row_count, CAST(8 AS BIGINT) AS column_count, count(*) - count(id) AS null_id,
       count(*) - count(state) AS null_state FROM ent""",
)
def quality_summary_query(spark, sf_dir):
    return summary_frame(entities(spark, sf_dir), ["id", "state"])


def result_sql(name, kind, severity, passed, actual, expected, message, source):
    return f"""
SELECT '{name}' AS name, '{kind}' AS rule_type, '{severity}' AS severity, {passed} AS passed,
       CAST({actual} AS DOUBLE) AS actual, '{expected}' AS expected, {message} AS message
FROM ({source})"""


def missing_sql(name, severity, column, most, source="ent"):
    return result_sql(
        name, "missing_count", severity, f"n <= {most}", "n", f"<= {most}",
        f"'missing_count({column})=' || n || ' (expected <= {most})'",
        f"SELECT count(*) - count({column}) AS n FROM {source}",
    )


def percent_sql(name, severity, column, most, source="ent"):
    return result_sql(
        name, "missing_percent", severity, f"p <= {most}", "round(p, 2)", f"<= {most}%",
        f"printf('missing_percent({column})=%.2f%% (expected <= {most}%%)', p)",
        f"SELECT CAST(count(*) - count({column}) AS DOUBLE) / count(*) * 100.0 AS p FROM {source}",
    )


def unique_sql(name, severity, column, source="ent"):
    return result_sql(
        name, "unique_count", severity, "d = 0", "d", "0",
        f"'unique_count({column})=' || d || ', repeats among ' || n || ' rows with a value'",
        f"SELECT count({column}) - count(DISTINCT {column}) AS d, count({column}) AS n FROM {source}",
    )


@query(
    "unique_count_check",
    f"WITH {ENTITY_SQL} {unique_sql('id_unique', 'fail', 'id')} UNION ALL {unique_sql('city_unique', 'warn', 'city')}",
)
def unique_count_check_query(spark, sf_dir):
    rules = [Rule("id_unique", "unique_count", ("id",)), Rule("city_unique", "unique_count", ("city",), severity="warn")]
    return evaluate(entities(spark, sf_dir), rules)


@query(
    "missing_percent_check",
    f"WITH {ENTITY_SQL} {percent_sql('id_rarely_missing', 'warn', 'id', 5.0)} UNION ALL "
    f"{percent_sql('state_rarely_missing', 'warn', 'state', 50.0)}",
)
def missing_percent_check_query(spark, sf_dir):
    rules = [
        Rule("id_rarely_missing", "missing_percent", ("id",), 5.0, "warn"),
        Rule("state_rarely_missing", "missing_percent", ("state",), 50.0, "warn"),
    ]
    return evaluate(entities(spark, sf_dir), rules)


SUITE_SQL = (
    f"WITH {ENTITY_SQL} "
    + " UNION ALL ".join(
        [
            result_sql("not_empty", "row_count", "fail", "n >= 1", "n", ">= 1",
                       "'row_count=' || n || ' (expected >= 1)'", "SELECT count(*) AS n FROM ent"),
            missing_sql("id_no_nulls", "fail", "id", 0),
            missing_sql("is_active_no_nulls", "fail", "is_active", 0),
            missing_sql("state_no_nulls", "fail", "state", 0),
            unique_sql("id_unique", "fail", "id"),
            percent_sql("name_rarely_missing", "warn", "name", 5.0),
            percent_sql("etype_rarely_missing", "warn", "etype", 5.0),
            percent_sql("state_rarely_missing", "warn", "state", 5.0),
            result_sql("etype_known", "relationships", "fail", "n = 0", "n", "0",
                       "'relationships(etype): ' || n || ' row(s) without a parent'",
                       "SELECT count(*) AS n FROM ent WHERE etype NOT IN (SELECT c_mktsegment FROM customer)"),
        ]
    )
)

SUITE = [
    Rule("not_empty", "row_count", limit=1),
    Rule("id_no_nulls", "missing_count", ("id",)),
    Rule("is_active_no_nulls", "missing_count", ("is_active",)),
    Rule("state_no_nulls", "missing_count", ("state",)),
    Rule("id_unique", "unique_count", ("id",)),
    Rule("name_rarely_missing", "missing_percent", ("name",), 5.0, "warn"),
    Rule("etype_rarely_missing", "missing_percent", ("etype",), 5.0, "warn"),
    Rule("state_rarely_missing", "missing_percent", ("state",), 5.0, "warn"),
    Rule("etype_known", "relationships", ("etype",)),
]


@query("dq_suite", SUITE_SQL)
def dq_suite_query(spark, sf_dir):
    return evaluate(entities(spark, sf_dir), SUITE, known_types(spark, sf_dir))


def known_types(spark, sf_dir):
    return {"etype_known": Reference(table(spark, sf_dir, "customer"), "c_mktsegment")}


def written_in_steps(steps, by):
    """A table to which each of ``steps`` is written, replacing the partitions it has rows for.

    Gives, after each, the table and the names of the partitions written.
    """
    spark, schema = steps[0].sparkSession, steps[0].schema
    path = fresh_path(spark, "partitioned")
    for rows in steps:
        overwrite_partitions(rows, path, [by])
        yield spark.read.schema(schema).parquet(path), rows.select(by).distinct()


@query("dq_incremental", SUITE_SQL)
def dq_incremental_query(spark, sf_dir):
    """The suite from kept metrics and a key register; only the rule that compares tables reads the table.

    Two of four partitions first hold other ids and no states and are replaced; only these are looked at again.
    """
    ent = entities(spark, sf_dir).withColumn("part", F.pmod(F.hash("country"), F.lit(4)))
    late = F.col("part") < 2
    first = ent.withColumns({"id": F.when(late, "same").otherwise(F.col("id")), "state": F.when(~late, F.col("state"))})
    root = fresh_path(spark, "kept")
    metrics = PartitionMetrics.of(ent, f"{root}/metrics", "part", ["id", "is_active", "state", "name", "etype"])
    register = KeyRegister(spark, f"{root}/ids", ("id",), "part")
    for stored, changed in written_in_steps([first, ent.filter(late)], "part"):
        metrics.refresh(stored, changed, RUN)
        register.refresh(stored, changed, RUN)
    compared = [r for r in SUITE if r.kind == "relationships"]
    counted = metrics.evaluate([r for r in SUITE if r not in compared], {register.columns: register})
    return counted.unionByName(evaluate(stored, compared, known_types(spark, sf_dir)))


@query(
    "profile_incremental",
    """
SELECT 'o_orderstatus' AS "column", count(*) AS rows, count(*) - count(o_orderstatus) AS nulls, min(o_orderstatus) AS least,
       max(o_orderstatus) AS greatest FROM orders
UNION ALL
SELECT 'o_custkey', count(*), count(*) - count(o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders""",
)
def profile_incremental_query(spark, sf_dir):
    """Counts and bounds of all orders, kept by year; the second half of the years comes later."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    metrics = PartitionMetrics.of(orders, fresh_path(spark, "metrics"), "year", ["o_orderstatus", "o_custkey"])
    for stored, changed in written_in_steps([orders.filter("year % 2 = 0"), orders.filter("year % 2 = 1")], "year"):
        metrics.refresh(stored, changed, RUN)
    return metrics.profile().drop("about_distinct")


@query(
    "unique_incremental",
    f"{unique_sql('order_unique', 'fail', 'o_orderkey', 'orders')} UNION ALL "
    f"{unique_sql('customer_unique', 'warn', 'o_custkey', 'orders')}",
)
def unique_incremental_query(spark, sf_dir):
    """Uniqueness against history: years written one half after the other, one of them a second time."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    first = orders.filter("year % 2 = 0").unionByName(orders.filter("year % 4 = 1").withColumn("o_custkey", F.lit(1).cast("long")))
    rules = [Rule("order_unique", "unique_count", ("o_orderkey",)), Rule("customer_unique", "unique_count", ("o_custkey",), severity="warn")]
    root = fresh_path(spark, "registers")
    registers = {r.columns: KeyRegister(spark, f"{root}/{r.name}", r.columns, "year") for r in rules}
    for stored, changed in written_in_steps([first, orders.filter("year % 2 = 1")], "year"):
        for register in registers.values():
            register.refresh(stored, changed, RUN)
    return PartitionMetrics(spark, f"{root}/rows", "year", ()).evaluate(rules, registers)


@query(
    "gold_checks",
    f"WITH {STAR_SQL} "
    + " UNION ALL ".join(
        [
            unique_sql("locations_location_key_unique", "fail", "location_key", "dim_loc"),
            *[missing_sql(f"locations_{c}_not_null", "fail", c, 0, "dim_loc") for c in ("location_key", "city", "state", "country")],
            unique_sql("types_type_key_unique", "fail", "type_key", "dim_type"),
            *[missing_sql(f"types_{c}_not_null", "fail", c, 0, "dim_type") for c in ("type_key", "etype")],
            missing_sql("types_type_description_not_null", "fail", "d", 0,
                        "(SELECT CASE WHEN upper(etype) <> 'FURNITURE' THEN etype END AS d FROM dim_type)").replace(
                            "missing_count(d)", "missing_count(type_description)"),
            unique_sql("fact_entity_key_unique", "fail", "entity_key", "fact"),
            *[missing_sql(f"fact_{c}_not_null", "fail", c, 0, "fact") for c in ("entity_key", "location_key", "type_key")],
            *[result_sql(f"{c}", "relationships", "fail", "n = 0", "n", "0",
                         f"'relationships({c}): ' || n || ' row(s) without a parent'",
                         f"SELECT count(*) AS n FROM fact WHERE {c} NOT IN (SELECT {c} FROM {d})")
              for c, d in (("location_key", "dim_loc"), ("type_key", "dim_type"))],
        ]
    ),
)
def gold_checks_query(spark, sf_dir):
    """What is checked before gold tables are published; the seed lacks one type."""
    ent = entities(spark, sf_dir)
    locations, types = dim_locations(ent), dim_types_query(spark, sf_dir)
    found = evaluate(locations, gold_rules("locations", ["location_key"], ["city", "state", "country"]))
    found = found.unionByName(evaluate(types, gold_rules("types", ["type_key"], ["etype", "type_description"])))
    parents = {"location_key": Reference(locations, "location_key"), "type_key": Reference(types, "type_key")}
    rules = gold_rules("fact", ["entity_key"], ["location_key", "type_key"], list(parents))
    return found.unionByName(evaluate(fact(ent), rules, parents))


@query(
    "relationships_check",
    """
SELECT o_custkey AS reference, count(*) AS rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 1000) GROUP BY 1""",
)
def relationships_check_query(spark, sf_dir):
    """Orders whose customer is not in the dimension of funded customers."""
    funded = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 1000)
    return missing_references(table(spark, sf_dir, "orders"), funded, "o_custkey", "c_custkey")


@query(
    "freshness_check",
    """
SELECT newest, hours AS age_hours, CASE WHEN hours > 49 THEN 'error' WHEN hours > 25 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS newest, date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 06:00:00') / 3600000000.0 AS hours
      FROM events)""",
)
def freshness_check_query(spark, sf_dir):
    return freshness(table(spark, sf_dir, "events"), "ts", instant(dt.datetime(2024, 2, 1, 6)))
