"""File scans, slices, writers and increments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafold.functions.temporal import day_of
from stratafold.operators.incremental import high_watermark, increment
from stratafold.operators.maintenance import compact, compact_partitions, partition_files
from stratafold.operators.quality import QualityError, Rule, run_suite
from stratafold.operators.versions import VersionedTable
from stratafold.operators.writers import append_partitions, land_json_by_date, overwrite_partitions, replace_table
from stratafold.plans.matches import rows_per_date
from stratafold.sources.files import partition, scan_csv, scan_dated_json, scan_json
from stratafold.sources.payload import PAYLOAD_DDL, finished, flatten_payload, landing_slice
from stratafold.workspace import fresh_path, materialise
from workload.proxies import MATCH_SQL, raw_matches
from workload.registry import query, table

PAGE_ROWS = 500
MIDDLE = "2024-01-16"
MIDDLE_TS = f"{MIDDLE} 00:00:00"


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def before_middle():
    return F.col("ts") < ntz(MIDDLE_TS)


@query(
    "json_folder_scan",
    """
SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' THEN NULL
       ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events""",
)
def json_folder_scan_query(spark, sf_dir):
    """Pages of a JSON array each, in one folder; text in a number field reads as NULL."""
    number = F.get_json_object("props", "$.k").cast("bigint")
    record = F.struct(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.when(F.col("event_type") == "error", F.lit("many")).alias("k_text"),
        F.when(F.col("event_type") != "error", number).alias("k"),
    )
    text = F.regexp_replace(F.to_json(record), '"k_text"', '"k"')
    pages = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list(text), ","), F.lit("]")).alias("value"))
    )
    folder = fresh_path(spark, "pages")
    pages.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    schema = T.StructType()
    for name, kind in [("event_id", "long"), ("user_id", "long"), ("event_type", "string"), ("value", "double"), ("k", "long")]:
        schema.add(name, kind)
    return scan_json(spark, folder, schema)


@query(
    "json_glob_path_date",
    "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS ingestion_date FROM events",
)
def json_glob_path_date_query(spark, sf_dir):
    folder = fresh_path(spark, "dated")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", day_of("ts").cast("string").alias("date"))
    land_json_by_date(events, folder)
    schema = T.StructType().add("event_id", "long").add("event_type", "string")
    return scan_dated_json(spark, f"{folder}/*/*.json", schema, documents=False)


@query("csv_dimension", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_dimension_query(spark, sf_dir):
    folder = fresh_path(spark, "seed")
    table(spark, sf_dir, "supplier").write.option("header", True).csv(folder)
    return scan_csv(spark, folder, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


TEXT_ROWS = """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '#' ELSE '' END || lang || ' "' || source || '"' || chr(10) || text AS note
FROM documents"""


@query("csv_text_dimension", TEXT_ROWS)
def csv_text_dimension_query(spark, sf_dir):
    """A text column with leading ``#``, quotes and line breaks, through CSV and back."""
    folder = fresh_path(spark, "texts")
    mark = F.when(F.col("doc_id") % 3 == 0, "#").otherwise("")
    note = F.concat(mark, F.col("lang"), F.lit(' "'), F.col("source"), F.lit('"\n'), F.col("text"))
    rows = table(spark, sf_dir, "documents").select(note.alias("note"), "doc_id")
    writer = rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(folder)
    return scan_csv(spark, folder, "note STRING, doc_id BIGINT", multi_line=True)


def landed_matches(spark, sf_dir):
    """Raw match documents, landed as text and read with their nested schema."""
    folder = fresh_path(spark, "raw-matches")
    raw_matches(spark, sf_dir).select("doc").write.text(folder)
    raw = spark.read.schema(PAYLOAD_DDL).json(folder)
    return flatten_payload(raw, "feed")


@query("json_flatten", f"WITH {MATCH_SQL} SELECT * FROM flat")
def json_flatten_query(spark, sf_dir):
    return landed_matches(spark, sf_dir)


@query(
    "finished_filter",
    f"WITH {MATCH_SQL} SELECT * FROM flat WHERE score_home IS NOT NULL AND match_started",
)
def finished_filter_query(spark, sf_dir):
    return finished(landed_matches(spark, sf_dir))


@query(
    "backfill_slice",
    f"WITH {MATCH_SQL} SELECT * FROM flat WHERE score_home IS NOT NULL AND match_started AND date <= '{MIDDLE}'",
)
def backfill_slice_query(spark, sf_dir):
    return landing_slice(finished(landed_matches(spark, sf_dir)), MIDDLE, first_run=True)


@query(
    "incremental_slice",
    f"WITH {MATCH_SQL} SELECT * FROM flat WHERE score_home IS NOT NULL AND match_started AND date = '{MIDDLE}'",
)
def incremental_slice_query(spark, sf_dir):
    return landing_slice(finished(landed_matches(spark, sf_dir)), MIDDLE, first_run=False)


def with_day(events):
    return events.withColumn("day", day_of("ts").cast("string"))


@query(
    "partition_scan",
    f"""
SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day
FROM events WHERE strftime(ts, '%Y-%m-%d') = '{MIDDLE}'""",
)
def partition_scan_query(spark, sf_dir):
    path = fresh_path(spark, "by-day")
    events = with_day(table(spark, sf_dir, "events"))
    replace_table(events, path, ["day"])
    return partition(spark.read.schema(events.schema).parquet(path), "day", MIDDLE)


@query(
    "overwrite_partitions_idempotent",
    f"""
SELECT event_id, ts, user_id, event_type, CASE WHEN ts < TIMESTAMP '{MIDDLE_TS}' THEN value ELSE value * 2 END AS value,
       props, strftime(ts, '%Y-%m-%d') AS day
FROM events""",
)
def overwrite_partitions_query(spark, sf_dir):
    """Write all days, then twice replace the later ones with corrected values."""
    path = fresh_path(spark, "corrected")
    events = with_day(table(spark, sf_dir, "events"))
    overwrite_partitions(events, path, ["day"])
    later = events.filter(~before_middle()).withColumn("value", F.col("value") * 2)
    overwrite_partitions(later, path, ["day"])
    overwrite_partitions(later, path, ["day"])
    return spark.read.schema(events.schema).parquet(path)


@query("rows_per_date", "SELECT strftime(ts, '%Y-%m-%d') AS ingestion_date, count(*) AS rows FROM events GROUP BY 1")
def rows_per_date_query(spark, sf_dir):
    dated = table(spark, sf_dir, "events").select(day_of("ts").cast("string").alias("ingestion_date"))
    return rows_per_date(dated)


@query(
    "high_watermark",
    """
SELECT max(ts) AS newest_event, (SELECT max(o_orderdate) FROM orders) AS newest_order FROM events""",
)
def high_watermark_query(spark, sf_dir):
    events = high_watermark(table(spark, sf_dir, "events"), "ts")
    orders = high_watermark(table(spark, sf_dir, "orders"), "o_orderdate")
    return spark.createDataFrame([(events, orders)], "newest_event TIMESTAMP_NTZ, newest_order TIMESTAMP_NTZ")


@query(
    "watermark_inclusive",
    f"SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{MIDDLE_TS}')",
)
def watermark_inclusive_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return increment(events, "ts", high_watermark(events.filter(before_middle()), "ts"))


@query(
    "watermark_strict",
    f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{MIDDLE_TS}')",
)
def watermark_strict_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return increment(events, "ts", high_watermark(events.filter(before_middle()), "ts"), inclusive=False)


@query(
    "audit_publish",
    f"SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < TIMESTAMP '{MIDDLE_TS}'",
)
def audit_publish_query(spark, sf_dir):
    """The first batch is published; the second breaks a rule and changes nothing."""
    versions = VersionedTable(spark, fresh_path(spark, "audited"))
    suite = ("events", [Rule("not_empty", "row_count", limit=1), Rule("typed", "missing_count", ("event_type",))])
    audit = lambda staged: run_suite(staged, suite)
    events = table(spark, sf_dir, "events")
    versions.publish(events.filter(before_middle()), dt.datetime(2024, 1, 16), audit=audit)
    damaged = events.withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    try:
        versions.publish(damaged, dt.datetime(2024, 1, 31), audit=audit)
    except QualityError:
        return versions.read()
    raise AssertionError("the damaged batch was published")


@query(
    "compaction_selective",
    f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, sum(event_id)::BIGINT AS ids, 1::BIGINT AS files,
       CASE WHEN strftime(ts, '%Y-%m-%d') < '{MIDDLE}' THEN 'packed' ELSE 'left alone' END AS done
FROM events GROUP BY ALL""",
)
def compaction_selective_query(spark, sf_dir):
    """Days before the middle come in three lots; only their partitions are packed."""
    path = fresh_path(spark, "lots")
    events = with_day(table(spark, sf_dir, "events"))
    early = F.col("day") < MIDDLE
    for lot in range(3):
        append_partitions(events.filter(early & (F.col("event_id") % 3 == lot)), path, ["day"])
    append_partitions(events.filter(~early), path, ["day"])
    before = partition_files(spark, path, "day").select("partition", F.col("files").alias("before"))
    before = materialise(before, "files-before")
    compact_partitions(spark.read.schema(events.schema).parquet(path), path, "day")
    after = partition_files(spark, path, "day").select("partition", "files").join(before, "partition")
    done = F.when(F.col("before") > F.col("files"), "packed").otherwise("left alone")
    counted = spark.read.schema(events.schema).parquet(path).groupBy("day").agg(
        F.count("*").alias("rows"), F.sum("event_id").alias("ids")
    )
    return counted.join(after, counted["day"] == after["partition"]).select("day", "rows", "ids", "files", done.alias("done"))


@query("compaction_preserves_rows", "SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day FROM events")
def compaction_query(spark, sf_dir):
    scattered, packed = fresh_path(spark, "scattered"), fresh_path(spark, "packed")
    events = with_day(table(spark, sf_dir, "events"))
    events.repartition(4).write.partitionBy("day").parquet(scattered)
    compact(spark.read.schema(events.schema).parquet(scattered), packed, ["day"])
    return spark.read.schema(events.schema).parquet(packed)
