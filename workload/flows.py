"""Whole flows: landed files to current state, gold tables and history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratafold.operators.buckets import BucketedTable
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.versions import VersionedTable
from stratafold.plans import contracts, gold
from stratafold.plans.entity import ingest_snapshot, silver_table, transform_snapshot
from stratafold.plans.matches import (
    add_stadium_state,
    derive_match_columns,
    ingest_matches,
    land_matches,
    read_matches,
    transform_matches,
)
from stratafold.sources.payload import PAYLOAD_DDL, finished
from stratafold.streaming.ingest import into_buckets, into_partitions, into_versions, keep_latest, stream_distinct, stream_files
from stratafold.workspace import fresh_path
from workload.feeds import landed_matches
from workload.proxies import MATCH_SQL, raw_matches
from workload.registry import query, table
from workload.state import LATEST_SQL

PAGE_ROWS = 200
DAY_ONE, DAY_TWO = "2026-01-15", "2026-01-16"
RUN_ONE, RUN_TWO = dt.datetime(2026, 1, 15, 6), dt.datetime(2026, 1, 16, 6)

# The second snapshot lacks the richest customers and renames one segment's.
SNAPSHOT_SQL = """
one AS (
  SELECT CASE WHEN c_acctbal < 100 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id, c_name AS name,
         CASE c_mktsegment WHEN 'FURNITURE' THEN 'micro' WHEN 'HOUSEHOLD' THEN ' nano' WHEN 'MACHINERY' THEN 'Regional'
                           WHEN 'BUILDING' THEN 'brewpub' ELSE 'large' END AS brewery_type,
         'road ' || CAST(c_custkey AS VARCHAR) AS address_1, n_name AS city,
         CASE WHEN c_acctbal < 2000 THEN NULL ELSE 'Nação ' || r_name END AS state, r_name AS country, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
silver AS (
  SELECT id, CASE WHEN c_acctbal < 9000 AND brewery_type = 'brewpub' THEN upper(name) ELSE name END AS name,
         brewery_type, address_1, city, coalesce(translate(state, 'çã', 'ca'), '__UNKNOWN__') AS state, country,
         c_acctbal < 9000 AS is_active,
         CASE WHEN c_acctbal >= 9000 OR (brewery_type = 'brewpub' AND upper(name) <> name)
              THEN TIMESTAMP '2026-01-16 06:00:00' ELSE TIMESTAMP '2026-01-15 06:00:00' END AS updated_at,
         '2026-01-15' AS ingestion_date
  FROM one WHERE id IS NOT NULL
)"""


def snapshots(spark, sf_dir):
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    one = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.when(balance >= 100, F.col("c_custkey").cast("string")).alias("id"),
            F.col("c_name").alias("name"),
            F.when(segment == "FURNITURE", "micro")
            .when(segment == "HOUSEHOLD", " nano")
            .when(segment == "MACHINERY", "Regional")
            .when(segment == "BUILDING", "brewpub")
            .otherwise("large")
            .alias("brewery_type"),
            F.concat(F.lit("road "), F.col("c_custkey").cast("string")).alias("address_1"),
            F.col("n_name").alias("city"),
            F.when(balance >= 2000, F.concat(F.lit("Nação "), F.col("r_name"))).alias("state"),
            F.col("r_name").alias("country"),
            "c_custkey",
            "c_acctbal",
        )
    )
    renamed = F.when(F.col("brewery_type") == "brewpub", F.upper("name")).otherwise(F.col("name"))
    return one, one.filter(balance < 9000).withColumn("name", renamed)


def land_pages(df, folder):
    """JSON arrays of a bounded number of rows, a line each: as many files as tasks, whatever the number of pages."""
    fields = [c for c in df.columns if c not in ("c_custkey", "c_acctbal")]
    pages = df.groupBy(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("page")).agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value")
    )
    pages.select("value").write.text(folder)


def run_entity_days(spark, sf_dir, after_each=None):
    base = fresh_path(spark, "entities")
    staging, bronze, silver, bad = (f"{base}/{n}" for n in ("staging", "bronze", "silver", "quarantine"))
    for df, day, run in zip(snapshots(spark, sf_dir), (DAY_ONE, DAY_TWO), (RUN_ONE, RUN_TWO)):
        land_pages(df, f"{staging}/{day}")
        ingest_snapshot(spark, staging, bronze, day, run, documents=False)
        transform_snapshot(spark, bronze, silver, bad, day, run)
        if after_each:
            after_each(silver_table(spark, silver).read(), base, run)
    return base, silver_table(spark, silver).read(), spark.read.parquet(bad)


@query("entity_flow", f"WITH {SNAPSHOT_SQL} SELECT * FROM silver")
def entity_flow_query(spark, sf_dir):
    """Two days of snapshots: upserts, soft deletes, first-seen dates."""
    _, silver, _ = run_entity_days(spark, sf_dir)
    return silver.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query(
    "gold_flow",
    f"""
WITH {SNAPSHOT_SQL},
agg AS (
  SELECT country, state, city, CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS active_breweries_count,
         CAST(sum(CASE WHEN is_active THEN 0 ELSE 1 END) AS BIGINT) AS inactive_breweries_count, count(*) AS total_breweries
  FROM silver GROUP BY 1, 2, 3
)
SELECT *, CAST(round(active_breweries_count * 100.0 / nullif(total_breweries, 0), 2) AS DOUBLE) AS active_ratio,
       dense_rank() OVER (PARTITION BY state ORDER BY active_breweries_count DESC) AS city_state_rank
FROM agg""",
)
def gold_flow_query(spark, sf_dir):
    """Gold tables after each day, the fact merged incrementally."""
    built = []
    run_entity_days(
        spark, sf_dir, lambda silver, base, run: built.append(gold.build_gold(spark, silver, f"{base}/gold", run))
    )
    return built[-1]["mart"]


@query(
    "history_flow",
    f"""
WITH {SNAPSHOT_SQL}
SELECT id, name, is_active, updated_at, updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM silver
UNION ALL
SELECT one.id, one.name, TRUE, TIMESTAMP '2026-01-15 06:00:00', TIMESTAMP '2026-01-15 06:00:00', TIMESTAMP '2026-01-16 06:00:00'
FROM one JOIN silver USING (id) WHERE silver.updated_at > TIMESTAMP '2026-01-15 06:00:00'""",
)
def history_flow_query(spark, sf_dir):
    """The type-2 history kept over both days."""
    base, _, _ = run_entity_days(
        spark, sf_dir, lambda silver, base, run: gold.snapshot_history(spark, silver, f"{base}/history", run)
    )
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("updated_at", "valid_from", "valid_to")]
    return gold.read_history(spark, f"{base}/history").select("id", "name", "is_active", *times)


SILVER_MATCH_SQL = """
SELECT ge_match_id, matchweek, date AS match_date,
       CASE WHEN kickoff_time = '' THEN NULL ELSE CAST(date || ' ' || kickoff_time || ':00' AS TIMESTAMP) END AS kickoff_ts,
       strip_accents(home_team) AS home_team, home_team_code, away_team, away_team_code, score_home, score_away, score_home + score_away AS total_goals,
       CASE WHEN score_home > score_away THEN 'HOME_WIN' WHEN score_home < score_away THEN 'AWAY_WIN' ELSE 'DRAW' END AS match_outcome,
       strip_accents(stadium) AS stadium, coalesce(venue.state, team.state, 'UNKNOWN') AS stadium_state,
       CASE WHEN venue.state IS NOT NULL THEN 'STADIUM_LOOKUP' WHEN team.state IS NOT NULL THEN 'HOME_TEAM_FALLBACK'
            ELSE 'UNKNOWN' END AS stadium_state_origin, date AS ingestion_date
FROM flat LEFT JOIN (VALUES ('Maracana', 'RJ')) venue(name, state) ON strip_accents(stadium) = venue.name
          LEFT JOIN (VALUES ('Sao Paulo', 'SP'), ('Flamengo', 'RJ')) team(name, state) ON strip_accents(home_team) = team.name
WHERE score_home IS NOT NULL AND match_started"""


MATCH_FLOW_SQL = f"WITH {MATCH_SQL} SELECT *, TRUE AS is_active FROM ({SILVER_MATCH_SQL})"


def run_match_days(spark, sf_dir):
    """Everything up to the last date but one, then the last; the state, and the arguments to merge again."""
    base = fresh_path(spark, "matches")
    staging, bronze, silver, bad, marks = (f"{base}/{n}" for n in ("staging", "bronze", "silver", "bad", "marks"))
    raw_matches(spark, sf_dir).select("doc").write.text(f"{base}/raw")
    raw = spark.read.schema(PAYLOAD_DDL).json(f"{base}/raw")
    dates = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    last_two = sorted(r.day for r in dates.orderBy(F.desc("day")).limit(2).collect())
    for day in last_two:
        land_matches(spark, raw, staging, day)
        ingest_matches(spark, staging, bronze, bad, dt.datetime.fromisoformat(f"{day} 23:00:00"), documents=False)
        transform_matches(spark, bronze, silver, bad, marks, dt.datetime.fromisoformat(f"{day} 23:30:00"))
    state = (
        read_matches(spark, silver)
        .drop("updated_at")
        .withColumn("kickoff_ts", F.col("kickoff_ts").cast("timestamp_ntz"))
        .withColumn("match_date", F.col("match_date").cast("string"))
    )
    return state, (bronze, silver, bad, marks)


@query("match_flow", MATCH_FLOW_SQL)
def match_flow_query(spark, sf_dir):
    """Backfill up to a date, then the next date as an increment."""
    return run_match_days(spark, sf_dir)[0]


@query("match_flow_rerun", f"SELECT *, FALSE AS merged_again FROM ({MATCH_FLOW_SQL})")
def match_flow_rerun_query(spark, sf_dir):
    """The same, merged twice more without news: nothing happens."""
    state, paths = run_match_days(spark, sf_dir)
    again = [transform_matches(spark, *paths, dt.datetime(2024, 3, day)) for day in (1, 2)]
    return state.withColumn("merged_again", F.lit(any(again)))


@query("match_enrich", f"WITH {MATCH_SQL} {SILVER_MATCH_SQL.replace(', date AS ingestion_date', '')}")
def match_enrich_query(spark, sf_dir):
    """Derived columns and the stadium cascade over all finished matches."""
    derived = derive_match_columns(finished(landed_matches(spark, sf_dir)))
    names = [n for n in contracts.MATCH_SILVER.names if n not in ("is_active", "updated_at", "ingestion_date")]
    return (
        add_stadium_state(derived)
        .select(*names)
        .withColumn("kickoff_ts", F.col("kickoff_ts").cast("timestamp_ntz"))
        .withColumn("match_date", F.col("match_date").cast("string"))
    )


def land_events(spark, sf_dir, folder):
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events = table(spark, sf_dir, "events")
    events.repartition(8, "event_id").write.option("timestampNTZFormat", micros).json(folder)
    return events.schema


@query("stream_ingest", LATEST_SQL)
def stream_ingest_query(spark, sf_dir):
    """Landed event files streamed in several batches into the latest row per user."""
    base = fresh_path(spark, "stream")
    schema = land_events(spark, sf_dir, f"{base}/landed")
    state = VersionedTable(spark, f"{base}/state")
    take = into_versions(state, keep_latest(["user_id"], "ts", ["event_id"]), dt.datetime(2024, 2, 1))
    stream_files(
        spark, f"{base}/landed", schema, take, checkpoint=f"{base}/progress", documents=False, files_per_batch=3
    )
    return state.read()


@query("stream_buckets", LATEST_SQL)
def stream_buckets_query(spark, sf_dir):
    """The same, each batch rewriting only the key buckets its users are in."""
    base = fresh_path(spark, "stream")
    schema = land_events(spark, sf_dir, f"{base}/landed")
    state = BucketedTable(spark, f"{base}/state", schema, ("user_id",), active=None, stamped=None)
    take = into_buckets(state, keep_latest(["user_id"], "ts", ["event_id"]), dt.datetime(2024, 2, 1))
    stream_files(
        spark, f"{base}/landed", schema, take, checkpoint=f"{base}/progress", documents=False, files_per_batch=3
    )
    return state.read()


@query(
    "stream_upsert",
    """
SELECT event_id, ts, user_id, event_type, value, props, TRUE AS is_active,
       TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM events""",
)
def stream_upsert_query(spark, sf_dir):
    """Landed event files streamed into a table partitioned by day, keyed by event."""
    base = fresh_path(spark, "stream")
    schema = land_events(spark, sf_dir, f"{base}/landed")
    stored = table(spark, sf_dir, "events").withColumns(
        {
            "is_active": F.lit(True),
            "updated_at": F.lit("2024-02-01").cast("timestamp_ntz"),
            "day": F.to_date("ts"),
        }
    )
    take = into_partitions(
        f"{base}/state",
        stored.schema,
        lambda batch: latest_per_key(batch, ["event_id"], "ts", ["user_id"]).withColumn("day", F.to_date("ts")),
        partition="day",
        keys=["event_id"],
        # The partition follows from ts, so an event that is sent again keeps its first time.
        update=["user_id", "event_type", "value", "props"],
        as_of=dt.datetime(2024, 2, 1),
        source_is_unique=True,
    )
    stream_files(
        spark, f"{base}/landed", schema, take, checkpoint=f"{base}/progress", documents=False, files_per_batch=4
    )
    return spark.read.schema(stored.schema).parquet(f"{base}/state").drop("day")


@query("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_dedup_query(spark, sf_dir):
    """Event files that are sent twice, the second time after a restart: every event stays once."""
    base = fresh_path(spark, "stream")
    schema = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).schema
    for lot in ("first", "again"):
        land_events(spark, sf_dir, f"{base}/landed/{lot}")
        stream_distinct(
            spark, f"{base}/landed", schema, f"{base}/distinct", ["event_id"], "ts",
            late="60 days", checkpoint=f"{base}/progress", documents=False, files_per_batch=3,
        )
    return spark.read.schema(schema).parquet(f"{base}/distinct").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
