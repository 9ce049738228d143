"""Stand-ins for the entity catalogue and the match feed, made from the tables.

Each is a DataFrame and the same text as a common table expression.  Dirt
(missing ids, odd case and spaces) follows from column values, so that both
sides derive it alike from every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.registry import table

ENTITY_SQL = """
ent AS (
  SELECT CASE WHEN c_acctbal < 100 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id,
         c_name AS name,
         CASE WHEN c_acctbal < 3000 THEN '  ' || lower(c_mktsegment)
              WHEN c_acctbal < 6000 THEN lower(c_mktsegment)
              ELSE c_mktsegment END AS etype,
         n_name || '-' || CAST(CAST(floor(c_acctbal / 2500) AS BIGINT) AS VARCHAR) AS city,
         CASE WHEN c_acctbal >= 9000 THEN NULL
              ELSE 'S' || CAST(CAST(floor(n_nationkey / 3.0) AS BIGINT) AS VARCHAR) END AS state,
         CASE WHEN c_acctbal < 2000 THEN '  ' || lower(r_name) || ' '
              WHEN c_acctbal < 4000 THEN lower(r_name)
              ELSE r_name END AS country,
         c_mktsegment <> 'BUILDING' AS is_active,
         TIMESTAMP '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS updated_at
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    segment, region = F.col("c_mktsegment"), F.col("r_name")
    whole = lambda c: F.floor(c).cast("bigint").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(balance >= 100, F.col("c_custkey").cast("string")).alias("id"),
            F.col("c_name").alias("name"),
            F.when(balance < 3000, F.concat(F.lit("  "), F.lower(segment)))
            .when(balance < 6000, F.lower(segment))
            .otherwise(segment)
            .alias("etype"),
            F.concat("n_name", F.lit("-"), whole(balance / 2500)).alias("city"),
            F.when(balance < 9000, F.concat(F.lit("S"), whole(F.col("n_nationkey") / 3.0))).alias("state"),
            F.when(balance < 2000, F.concat(F.lit("  "), F.lower(region), F.lit(" ")))
            .when(balance < 4000, F.lower(region))
            .otherwise(region)
            .alias("country"),
            (segment != "BUILDING").alias("is_active"),
            F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE").alias("updated_at"),
        )
    )


# Latest order of each customer and priority: before a date, and from it on.
SPLIT_DATE = "1998-05-01 00:00:00"

ORDER_STATE_SQL = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderdate < TIMESTAMP '{SPLIT_DATE}'
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
),
tgt AS (
  SELECT o_custkey, o_orderpriority, o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderstatus <> 'F' AS is_active, TIMESTAMP '1998-05-01 00:00:00' AS updated_at
  FROM ranked WHERE rn = 1 AND o_orderdate < TIMESTAMP '{SPLIT_DATE}'
),
src AS (
  SELECT o_custkey, o_orderpriority, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
  FROM ranked WHERE rn = 1 AND o_orderdate >= TIMESTAMP '{SPLIT_DATE}'
)"""

# The match feed: an event is a match, its value and its counter the scores.
MATCH_SQL = """
flat AS (
  SELECT CAST(user_id AS INTEGER) AS matchweek,
         CASE event_type WHEN 'click' THEN 'Unknown' WHEN 'purchase' THEN 'São Paulo' ELSE event_type END AS home_team,
         CASE WHEN event_type = 'click' THEN '' ELSE upper(event_type) END AS home_team_code,
         'visitor ' || CAST(user_id AS VARCHAR) AS away_team,
         '' AS away_team_code,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS score_home,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS score_away,
         strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN value < 10 THEN '' ELSE strftime(ts, '%H:%M') END AS kickoff_time,
         CASE WHEN value < 20 THEN 'Unknown' WHEN value >= 45 THEN 'Maracanã' ELSE 'ground ' || event_type END AS stadium,
         CASE WHEN value < 30 THEN '' ELSE 'channel ' || event_type END AS broadcast,
         CASE WHEN value < 40 THEN '' ELSE 'http://match/' || CAST(event_id AS VARCHAR) END AS match_url,
         CASE WHEN event_type = 'signup' THEN FALSE ELSE value > 5 END AS match_started,
         'feed' AS source,
         CAST(event_id AS VARCHAR) AS ge_match_id
  FROM events
  WHERE NOT (event_type = 'error' AND value >= 100)
)"""


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a raw nested match document (a column ``doc`` of JSON text)."""
    kind, value = F.col("event_type"), F.col("value")
    unless = lambda condition, c: F.when(~condition, c)
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("landed_on"),
        F.to_json(
            F.struct(
                F.col("user_id").cast("int").alias("rodada"),
                F.col("event_id").cast("string").alias("id"),
                unless((kind == "error") & (value >= 100), F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias(
                    "data_realizacao"
                ),
                F.when(value >= 10, F.date_format("ts", "HH:mm")).alias("hora_realizacao"),
                F.struct(
                    F.struct(
                        F.when(kind == "purchase", "São Paulo").otherwise(unless(kind == "click", kind)).alias("nome_popular"),
                        unless(kind == "click", F.upper(kind)).alias("sigla"),
                    ).alias("mandante"),
                    F.struct(
                        F.concat(F.lit("visitor "), F.col("user_id").cast("string")).alias("nome_popular"),
                        F.lit(None).cast("string").alias("sigla"),
                    ).alias("visitante"),
                ).alias("equipes"),
                unless(kind == "view", F.floor(value).cast("int")).alias("placar_oficial_mandante"),
                F.get_json_object("props", "$.k").cast("int").alias("placar_oficial_visitante"),
                F.when(
                    value >= 20,
                    F.struct(F.when(value >= 45, "Maracanã").otherwise(F.concat(F.lit("ground "), kind)).alias("nome_popular")),
                ).alias("sede"),
                unless(kind == "signup", value > 5).alias("jogo_ja_comecou"),
                F.when(
                    value >= 30,
                    F.struct(
                        F.when(
                            value >= 40, F.concat(F.lit("http://match/"), F.col("event_id").cast("string"))
                        ).alias("url"),
                        F.struct(F.concat(F.lit("channel "), kind).alias("label")).alias("broadcast"),
                    ),
                ).alias("transmissao"),
            )
        ).alias("doc"),
    )
