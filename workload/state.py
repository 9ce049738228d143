"""Deduplication, quarantine, lookups, merges, history, upkeep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratafold.functions.temporal import ntz as instant
from stratafold.functions.text import null_to_sentinel
from stratafold.operators.buckets import BucketedTable
from stratafold.operators.dedup import latest_per_key, latest_per_key_agg
from stratafold.operators.lookup import LookupStep, coverage, lookup_cascade, lookup_left, prepare_lookup
from stratafold.operators.maintenance import compaction_plan, expired_versions, orphan_files, unlisted_folders
from stratafold.operators.merge import key_bucket, merge_changed_buckets, merge_newer, merge_table, merge_touched_partitions, shrink_report
from stratafold.operators.quality import evaluate, Rule
from stratafold.operators.quarantine import NULL_ID, quarantine_rows, split_invalid, write_quarantine
from stratafold.operators.ranking import dense_rank_cut
from stratafold.operators.scd2 import apply_changes, as_of, as_of_join, closed_versions, open_versions, version_intervals
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import replace_table
from stratafold.workspace import fresh_path, materialise
from workload.feeds import MIDDLE_TS, before_middle
from workload.proxies import ENTITY_SQL, ORDER_STATE_SQL, SPLIT_DATE, entities
from workload.registry import query, table

RUN = dt.datetime(2024, 2, 1)
RUN_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

LATEST_SQL = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


@query("latest_per_key", LATEST_SQL)
def latest_per_key_query(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


@query("latest_per_key_ties", LATEST_SQL.replace("FROM events", "FROM (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM events)"))
def latest_per_key_ties_query(spark, sf_dir):
    """By the hour, users have several latest events; the tie-break decides."""
    hourly = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return latest_per_key(hourly, ["user_id"], "ts", ["event_id"])


@query("latest_per_key_agg", LATEST_SQL)
def latest_per_key_agg_query(spark, sf_dir):
    return latest_per_key_agg(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])


@query(
    "quarantine_split",
    f"""
WITH {ENTITY_SQL}
SELECT name, id, state, CASE WHEN id IS NULL THEN 'NULL_ID' WHEN state IS NULL THEN 'NULL_STATE' END AS quarantine_reason,
       CASE WHEN id IS NULL OR state IS NULL THEN {RUN_SQL} END AS quarantined_at,
       CASE WHEN id IS NULL OR state IS NULL THEN '2024-02-01' END AS quarantine_date
FROM ent""",
)
def quarantine_split_query(spark, sf_dir):
    """Bad rows go through the append-only sink; with the good ones they are the input."""
    rows = entities(spark, sf_dir).select("name", "id", "state")
    good, bad = split_invalid(rows, [(NULL_ID, F.col("id").isNull()), ("NULL_STATE", F.col("state").isNull())])
    path = fresh_path(spark, "quarantine")
    records = quarantine_rows(bad, ["name", "id", "state"], "2024-02-01", instant(RUN))
    write_quarantine(records, path)
    kept = spark.read.schema(records.schema).parquet(path)
    return kept.unionByName(good, allowMissingColumns=True)


# --- lookups -----------------------------------------------------------------

LOOKUP_SQL = """
SELECT o_orderkey, coalesce(a.v, b.v, 'UNKNOWN') AS segment,
       CASE WHEN a.v IS NOT NULL THEN 'CUSTOMER' WHEN b.v IS NOT NULL THEN 'PRIORITY' ELSE 'UNKNOWN' END AS segment_origin
FROM orders
LEFT JOIN (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) a
       ON o_custkey = a.k
LEFT JOIN (SELECT DISTINCT o_orderpriority AS k, lower(o_orderpriority) AS v FROM orders
           WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) b ON o_orderpriority = b.k"""


def segment_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return prepare_lookup(customers, "c_custkey", "c_mktsegment", normalise=F.col)


def segmented_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    urgent = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    priorities = prepare_lookup(
        urgent.select("o_orderpriority", F.lower("o_orderpriority").alias("name")), "o_orderpriority", "name"
    )
    steps = [
        LookupStep(segment_lookup(spark, sf_dir), "o_custkey", "CUSTOMER"),
        LookupStep(priorities, "o_orderpriority", "PRIORITY"),
    ]
    return lookup_cascade(
        orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
        steps,
        value_column="segment",
        origin_column="segment_origin",
    )


@query(
    "lookup_left_join",
    """
SELECT o_orderkey, c.c_mktsegment AS segment FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) c ON o_custkey = c_custkey""",
)
def lookup_left_join_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    step = LookupStep(segment_lookup(spark, sf_dir), "o_custkey", "CUSTOMER")
    return lookup_left(orders, step, "segment").select("o_orderkey", "segment")


@query("lookup_cascade", LOOKUP_SQL)
def lookup_cascade_query(spark, sf_dir):
    return segmented_orders(spark, sf_dir).select("o_orderkey", "segment", "segment_origin")


@query("lookup_coverage", f"SELECT segment_origin, count(*) AS rows FROM ({LOOKUP_SQL}) GROUP BY 1")
def lookup_coverage_query(spark, sf_dir):
    return coverage(segmented_orders(spark, sf_dir), "segment_origin")


@query(
    "lookup_rarely_hit",
    """
SELECT o_orderkey, o_custkey, c_name AS indebted FROM orders
LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey""",
)
def lookup_rarely_hit_query(spark, sf_dir):
    """A lookup held to be too large to broadcast, that few rows hit: a Bloom filter keeps the others out of the join."""
    indebted = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    step = LookupStep(indebted, "o_custkey", "CUSTOMER", key="c_custkey", value="c_name", max_rows=0, rarely_hit=True)
    return lookup_left(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), step, "indebted")


# --- merges ------------------------------------------------------------------


def order_states(spark, sf_dir):
    """Latest order per customer and priority, before the split date and from it on."""
    orders = table(spark, sf_dir, "orders")
    keys = ["o_custkey", "o_orderpriority"]
    early = F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    target = latest_per_key(orders.filter(early), keys, "o_orderdate", ["o_orderkey"]).withColumns(
        {
            "is_active": F.col("o_orderstatus") != "F",
            "updated_at": F.lit(SPLIT_DATE).cast("timestamp_ntz"),
        }
    )
    source = latest_per_key(orders.filter(~early), keys, "o_orderdate", ["o_orderkey"])
    return target, source


def merge_sql(update: str, gone: str, gone_stamp: str, matched_stamp: str) -> str:
    return f"""
WITH {ORDER_STATE_SQL}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
       coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority, {update},
       CASE WHEN s.o_custkey IS NOT NULL THEN TRUE ELSE {gone} END AS is_active,
       CASE WHEN t.o_custkey IS NULL THEN {RUN_SQL} WHEN s.o_custkey IS NOT NULL THEN {matched_stamp}
            ELSE {gone_stamp} END AS updated_at
FROM tgt t FULL OUTER JOIN src s ON t.o_custkey = s.o_custkey AND t.o_orderpriority = s.o_orderpriority"""


def updated(*names: str) -> str:
    return ", ".join(f"CASE WHEN s.o_custkey IS NOT NULL THEN s.{n} ELSE t.{n} END AS {n}" for n in names)


def locked(*names: str) -> str:
    return ", ".join(f"CASE WHEN t.o_custkey IS NOT NULL THEN t.{n} ELSE s.{n} END AS {n}" for n in names)


ALL = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query("merge_soft_delete", merge_sql(updated(*ALL), "FALSE", RUN_SQL, RUN_SQL))
def merge_soft_delete_query(spark, sf_dir):
    target, source = order_states(spark, sf_dir)
    return merge_table(
        target,
        source,
        keys=["o_custkey", "o_orderpriority"],
        update=ALL,
        as_of=instant(RUN),
        on_missing="deactivate",
        touch="always",
        source_is_unique=True,
    )


@query(
    "merge_touch_changed",
    merge_sql(
        updated("o_orderstatus") + ", " + locked("o_orderkey", "o_totalprice", "o_orderdate"),
        "FALSE",
        f"CASE WHEN t.is_active THEN {RUN_SQL} ELSE t.updated_at END",
        f"CASE WHEN t.is_active AND t.o_orderstatus = s.o_orderstatus THEN t.updated_at ELSE {RUN_SQL} END",
    ),
)
def merge_touch_changed_query(spark, sf_dir):
    target, source = order_states(spark, sf_dir)
    return merge_table(
        target,
        source,
        keys=["o_custkey", "o_orderpriority"],
        update=["o_orderstatus"],
        as_of=instant(RUN),
        on_missing="deactivate",
    )


UPSERT_SQL = merge_sql(
    updated("o_orderkey", "o_orderstatus", "o_totalprice") + ", " + locked("o_orderdate"),
    "t.is_active",
    "t.updated_at",
    RUN_SQL,
)


@query("merge_upsert", UPSERT_SQL)
def merge_upsert_query(spark, sf_dir):
    target, source = order_states(spark, sf_dir)
    return merge_table(
        target,
        source,
        keys=["o_custkey", "o_orderpriority"],
        update=["o_orderkey", "o_orderstatus", "o_totalprice"],
        as_of=instant(RUN),
        touch="always",
    )


@query("merge_upsert_buckets", UPSERT_SQL)
def merge_upsert_buckets_query(spark, sf_dir):
    """The same upsert into a bucketed table: the keys of the source alone tell which buckets are read."""
    target, source = order_states(spark, sf_dir)
    state = BucketedTable(spark, fresh_path(spark, "by-key"), target.schema, ("o_custkey", "o_orderpriority"))
    state.fold(materialise(target, "target"), lambda current, rows: rows, as_of=RUN)
    state.merge(
        materialise(source, "source"),
        update=["o_orderkey", "o_orderstatus", "o_totalprice"],
        as_of=RUN,
        touch="always",
    )
    return state.read()


@query("merge_touched_partitions", UPSERT_SQL)
def merge_touched_partitions_query(spark, sf_dir):
    """The same upsert into a table partitioned by the month of the first order."""
    target, source = order_states(spark, sf_dir)
    month = F.trunc("o_orderdate", "month")
    path = fresh_path(spark, "by-month")
    target = target.withColumn("month", month)
    replace_table(target, path, ["month"])
    stored = spark.read.schema(target.schema).parquet(path)
    merge_touched_partitions(
        stored,
        materialise(source.withColumn("month", month), "source"),
        path,
        partition="month",
        keys=["o_custkey", "o_orderpriority"],
        update=["o_orderkey", "o_orderstatus", "o_totalprice"],
        as_of=instant(RUN),
        touch="always",
    )
    return spark.read.schema(target.schema).parquet(path).drop("month")


@query(
    "merge_changed_buckets",
    merge_sql(
        updated("o_orderstatus") + ", " + locked("o_orderkey", "o_totalprice", "o_orderdate"),
        "FALSE",
        f"CASE WHEN t.is_active THEN {RUN_SQL} ELSE t.updated_at END",
        f"CASE WHEN t.is_active AND t.o_orderstatus = s.o_orderstatus THEN t.updated_at ELSE {RUN_SQL} END",
    ),
)
def merge_changed_buckets_query(spark, sf_dir):
    """A soft-delete merge into a table bucketed by key; merged again, no bucket changes."""
    target, source = order_states(spark, sf_dir)
    keys = ["o_custkey", "o_orderpriority"]
    bucketed = target.withColumn("bucket", key_bucket(keys, 16))
    path = fresh_path(spark, "buckets")
    replace_table(bucketed, path, ["bucket"])
    source = materialise(source.withColumn("bucket", key_bucket(keys, 16)), "source")
    for _ in range(2):
        stored = spark.read.schema(bucketed.schema).parquet(path)
        rewritten = merge_changed_buckets(
            stored, source, path, bucket="bucket", keys=keys, update=["o_orderstatus"], as_of=instant(RUN),
            on_missing="deactivate", source_is_unique=True,
        )
    if rewritten:
        raise AssertionError("a merge without news rewrote buckets")
    return spark.read.schema(bucketed.schema).parquet(path).drop("bucket")


@query(
    "schema_append_columns",
    f"""
WITH {ENTITY_SQL}
SELECT id, name, CASE WHEN state IS NOT NULL THEN etype END AS etype
FROM ent WHERE id IS NOT NULL AND (is_active OR state IS NOT NULL)""",
)
def schema_append_columns_query(spark, sf_dir):
    rows = entities(spark, sf_dir).filter(F.col("id").isNotNull())
    return merge_table(
        rows.filter("is_active").select("id", "name"),
        rows.filter(F.col("state").isNotNull()).select("id", "name", "etype"),
        keys=["id"],
        update=["name"],
        active=None,
        stamped=None,
        evolve=True,
    )


@query(
    "fact_incremental",
    f"""
WITH {ENTITY_SQL}, hw AS (SELECT max(updated_at) AS ts FROM ent WHERE id IS NOT NULL AND is_active)
SELECT md5(upper(trim(id))) AS entity_key, CASE WHEN updated_at > (SELECT ts FROM hw) THEN upper(name) ELSE name END AS name,
       is_active, updated_at
FROM ent WHERE id IS NOT NULL AND (is_active OR updated_at > (SELECT ts FROM hw))""",
)
def fact_incremental_query(spark, sf_dir):
    """The target holds active entities; of the renamed source only newer rows count."""
    rows = entities(spark, sf_dir).filter(F.col("id").isNotNull())
    facts = rows.select(F.md5(F.upper(F.trim("id"))).alias("entity_key"), "name", "is_active", "updated_at")
    renamed = facts.withColumn("name", F.upper("name"))
    return merge_newer(facts.filter("is_active"), renamed, keys=["entity_key"], changed_at="updated_at")


@query(
    "shrink_guard",
    f"""
WITH {ENTITY_SQL}, n AS (
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM ent WHERE id IS NOT NULL AND is_active) AS previous_active,
         (SELECT CAST(count(*) AS BIGINT) FROM ent WHERE id IS NOT NULL AND state IS NOT NULL AND etype = upper(etype)) AS current_rows)
SELECT previous_active, current_rows, CAST(floor(CAST(previous_active AS DOUBLE) * 0.8) AS BIGINT) AS threshold,
       previous_active = 0 OR current_rows >= CAST(floor(CAST(previous_active AS DOUBLE) * 0.8) AS BIGINT) AS passed
FROM n""",
)
def shrink_guard_query(spark, sf_dir):
    rows = entities(spark, sf_dir).filter(F.col("id").isNotNull())
    source = rows.filter(F.col("state").isNotNull() & (F.col("etype") == F.upper("etype")))
    return shrink_report(source, rows)


# --- history -----------------------------------------------------------------

HISTORY_SQL = """
SELECT event_id, ts, user_id, event_type, value, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"""


def user_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def history(spark, sf_dir):
    return version_intervals(user_events(spark, sf_dir), ["user_id"], "ts", ["event_id"])


@query("scd2_history", HISTORY_SQL)
def scd2_history_query(spark, sf_dir):
    return history(spark, sf_dir)


@query("scd2_history_sliced", HISTORY_SQL)
def scd2_history_sliced_query(spark, sf_dir):
    """The same history, cut into a given number of ranges."""
    return version_intervals(user_events(spark, sf_dir), ["user_id"], "ts", ["event_id"], ranges=13)


TIED_SQL = HISTORY_SQL.replace("FROM events", "FROM (SELECT * REPLACE (date_trunc('day', ts) AS ts) FROM events)")


@query("scd2_history_ties", TIED_SQL)
def scd2_history_ties_query(spark, sf_dir):
    """The history by day: many changes of a user at one time, of which the last counts."""
    daily = user_events(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return version_intervals(daily, ["user_id"], "ts", ["event_id"], ranges=7)


@query("scd2_incremental", HISTORY_SQL)
def scd2_incremental_query(spark, sf_dir):
    """History of the earlier half, then the later half applied to its open versions."""
    events = user_events(spark, sf_dir)
    first = version_intervals(events.filter(before_middle()), ["user_id"], "ts", ["event_id"])
    changed = apply_changes(
        materialise(open_versions(first), "open"), events.filter(~before_middle()), ["user_id"], "ts", ["event_id"]
    )
    return closed_versions(first).unionByName(changed)


@query(
    "scd2_as_of",
    f"SELECT * FROM ({HISTORY_SQL}) WHERE valid_from <= TIMESTAMP '{MIDDLE_TS}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{MIDDLE_TS}')",
)
def scd2_as_of_query(spark, sf_dir):
    return as_of(history(spark, sf_dir), F.lit(MIDDLE_TS).cast("timestamp_ntz"))


@query(
    "scd2_as_of_join",
    f"""
WITH points AS (SELECT event_id AS point_id, user_id, ts + INTERVAL 30 HOUR AS instant FROM events
                UNION ALL SELECT -event_id, user_id, ts - INTERVAL 30 HOUR FROM events)
SELECT point_id, user_id, instant, event_id, event_type, value, valid_from, valid_to
FROM points LEFT JOIN ({HISTORY_SQL}) h USING (user_id)
WHERE h.event_id IS NULL OR (valid_from <= instant AND (valid_to IS NULL OR valid_to > instant))
UNION ALL
SELECT point_id, user_id, instant, NULL, NULL, NULL, NULL, NULL
FROM points JOIN (SELECT user_id, min(ts) AS first FROM events GROUP BY 1) USING (user_id) WHERE instant < first""",
)
def scd2_as_of_join_query(spark, sf_dir):
    """For every event what was valid for its user thirty hours before and after."""
    events = user_events(spark, sf_dir)
    later = F.expr("INTERVAL 30 HOURS")
    points = events.select(F.col("event_id").alias("point_id"), "user_id", (F.col("ts") + later).alias("instant")).unionByName(
        events.select((-F.col("event_id")).alias("point_id"), "user_id", (F.col("ts") - later).alias("instant"))
    )
    return as_of_join(points, history(spark, sf_dir).drop("ts"), ["user_id"], "instant")


@query(
    "rank_hot_group",
    """
SELECT l_orderkey, l_linenumber, l_returnflag,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS price_rank
FROM lineitem""",
)
def rank_hot_group_query(spark, sf_dir):
    """Ranks among all lines of a return flag: few groups, each with very many prices."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return dense_rank_cut(lines, ["l_returnflag"], "l_extendedprice", "price_rank").drop("l_extendedprice")


@query(
    "scd2_unique_check",
    f"""
SELECT 'version_unique' AS name, 'unique_count' AS rule_type, 'fail' AS severity, d = 0 AS passed, CAST(d AS DOUBLE) AS actual,
       '0' AS expected, 'unique_count(user_id, valid_from)=' || d || ', repeats among ' || n || ' rows with a value' AS message
FROM (SELECT count(*) - count(DISTINCT (user_id, valid_from)) AS d, count(*) AS n FROM ({HISTORY_SQL}))""",
)
def scd2_unique_check_query(spark, sf_dir):
    return evaluate(history(spark, sf_dir), [Rule("version_unique", "unique_count", ("user_id", "valid_from"))])


# --- upkeep ------------------------------------------------------------------


@query(
    "snapshot_expiry",
    """
SELECT event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn > 5 AND ts < TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY""",
)
def snapshot_expiry_query(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return expired_versions(log, instant(dt.datetime(2024, 2, 10)), version="event_id", published_at="ts")


@query(
    "compaction_plan",
    """
WITH files AS (
  SELECT o_orderpriority AS partition, CAST(o_orderkey AS VARCHAR) AS path, CAST(floor(o_totalprice) AS BIGINT) AS length FROM orders
), binned AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY partition ORDER BY length, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 // 200000 AS BIGINT) AS bin
  FROM files WHERE length < 200000
)
SELECT *, count(*) OVER (PARTITION BY partition, bin) AS bin_files,
       CAST(sum(length) OVER (PARTITION BY partition, bin) AS BIGINT) AS bin_bytes
FROM binned QUALIFY count(*) OVER (PARTITION BY partition, bin) > 1""",
)
def compaction_plan_query(spark, sf_dir):
    """Orders as files: a priority is a partition, a total price a length."""
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("partition"), F.col("o_orderkey").cast("string").alias("path"), F.floor("o_totalprice").cast("long").alias("length")
    )
    return compaction_plan(files, small_file_bytes=200_000)


@query("orphan_versions", "SELECT 'crashed' AS name, count(*) AS kept_rows FROM events WHERE ts >= TIMESTAMP '" + MIDDLE_TS + "'")
def orphan_versions_query(spark, sf_dir):
    """Folders of a versioned table that no log entry names, from the real listing."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    versions = VersionedTable(spark, fresh_path(spark, "versions"))
    versions.publish(events.filter(before_middle()), dt.datetime(2024, 1, 16))
    versions.publish(events.filter(~before_middle()), dt.datetime(2024, 1, 31))
    replace_table(events, f"{versions.data_path}/crashed")
    names = [path.rpartition("/")[2] for path in unlisted_folders(versions, dt.datetime(2100, 1, 1))]
    return versions.read().agg(F.lit(",".join(names)).alias("name"), F.count("*").alias("kept_rows"))


@query(
    "orphan_files",
    """
SELECT event_id, ts, event_type FROM events
WHERE ts < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 3 DAY
  AND event_id NOT IN (SELECT event_id FROM events WHERE event_type <> 'error')""",
)
def orphan_files_query(spark, sf_dir):
    files = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    manifest = files.filter(F.col("event_type") != "error")
    return orphan_files(files, manifest, instant(dt.datetime(2024, 1, 25)), path="event_id", modified_at="ts")
