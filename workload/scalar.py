"""Projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratafold.functions.measures import outcome, total
from stratafold.functions.temporal import compose_timestamp, logical_timestamp, month_of, parse_date
from stratafold.functions.text import (
    ACCENTED,
    PLAIN,
    business_key,
    canonical,
    null_to_sentinel,
    regex_group,
    strip_accents,
    surrogate_key,
)
from workload.proxies import ENTITY_SQL, entities
from workload.registry import query, table


@query(
    "strip_accents",
    f"""
SELECT doc_id, md5(translate(text, '{ACCENTED}', '{PLAIN}')) AS plain_md5,
       length(translate(text, '{ACCENTED}', '{PLAIN}')) AS plain_length,
       text <> translate(text, '{ACCENTED}', '{PLAIN}') AS changed
FROM documents""",
)
def strip_accents_query(spark, sf_dir):
    plain = strip_accents("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(plain).alias("plain_md5"),
        F.length(plain).cast("bigint").alias("plain_length"),
        (F.col("text") != plain).alias("changed"),
    )


@query(
    "regex_extract",
    r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       regexp_extract(url, '/([a-z]{2})/', 1) AS lang_folder,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title
FROM pages""",
)
def regex_extract_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        regex_group("url", r"^[a-z]+://([^/?#]+)").alias("host"),
        regex_group("url", r"/([a-z]{2})/").alias("lang_folder"),
        regex_group("html", r"<title>([^<]*)</title>").alias("title"),
    )


@query(
    "null_sentinel",
    f"WITH {ENTITY_SQL} SELECT name, coalesce(id, '__UNKNOWN__') AS id, coalesce(state, '__UNKNOWN__') AS state FROM ent",
)
def null_sentinel_query(spark, sf_dir):
    return entities(spark, sf_dir).select(
        "name", null_to_sentinel("id").alias("id"), null_to_sentinel("state").alias("state")
    )


@query(
    "parse_date",
    """
SELECT o_orderkey, CAST(CAST(try_strptime(d, '%Y-%m-%d') AS DATE) AS VARCHAR) AS order_date FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                     ELSE CASE WHEN o_totalprice < 100000 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS d
  FROM orders)""",
)
def parse_date_query(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderstatus") == "P", "")
        .when(F.col("o_orderstatus") == "F", day)
        .when(F.col("o_totalprice") < 100000, "unknown")
        .otherwise(day)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_date(text).cast("string").alias("order_date"))


@query(
    "compose_timestamp",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
       CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('minute', ts) END AS starts_at,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS logical_ts
FROM events""",
)
def compose_timestamp_query(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    minute = F.when(F.col("event_type") == "error", "").otherwise(F.date_format("ts", "HH:mm"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        day.alias("day"),
        compose_timestamp(day, minute).cast("timestamp_ntz").alias("starts_at"),
        logical_timestamp(day).cast("timestamp_ntz").alias("logical_ts"),
    )


@query(
    "derive_total_outcome",
    """
SELECT event_id, home + away AS total,
       CASE WHEN home > away THEN 'HOME_WIN' WHEN home < away THEN 'AWAY_WIN' ELSE 'DRAW' END AS outcome
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS home,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS away FROM events)""",
)
def derive_total_outcome_query(spark, sf_dir):
    scores = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.floor("value").cast("bigint")).alias("home"),
        F.get_json_object("props", "$.k").cast("bigint").alias("away"),
    )
    return scores.select(
        "event_id", total("home", "away").alias("total"), outcome("home", "away").alias("outcome")
    )


@query(
    "canonical_text",
    f"""
WITH {ENTITY_SQL}
SELECT name, upper(trim(coalesce(etype, ''))) AS etype, upper(trim(coalesce(country, ''))) AS country,
       upper(trim(coalesce(state, ''))) AS state FROM ent""",
)
def canonical_text_query(spark, sf_dir):
    return entities(spark, sf_dir).select(
        "name", canonical("etype").alias("etype"), canonical("country").alias("country"), canonical("state").alias("state")
    )


@query(
    "surrogate_key",
    f"""
WITH {ENTITY_SQL}
SELECT name, md5(upper(trim(id))) AS entity_key,
       md5(upper(trim(coalesce(country, ''))) || '|' || upper(trim(coalesce(state, ''))) || '|' ||
           upper(trim(coalesce(city, '')))) AS location_key
FROM ent""",
)
def surrogate_key_query(spark, sf_dir):
    return entities(spark, sf_dir).select(
        "name", business_key("id").alias("entity_key"), surrogate_key("country", "state", "city").alias("location_key")
    )


@query(
    "month_bucket",
    """
SELECT strftime(o_orderdate, '%Y-%m-01') AS month, count(*) AS orders
FROM orders GROUP BY 1""",
)
def month_bucket_query(spark, sf_dir):
    month = month_of("o_orderdate").cast("string").alias("month")
    return table(spark, sf_dir, "orders").groupBy(month).agg(F.count("*").alias("orders"))
