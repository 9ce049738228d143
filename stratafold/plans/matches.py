"""Match feed: dated files to bronze by watermark, bronze to current state."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.measures import outcome, total
from stratafold.functions.temporal import compose_timestamp, logical_timestamp, month_of, parse_date, stamp
from stratafold.functions.text import strip_accents
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.incremental import high_watermark, increment, listed_watermark
from stratafold.operators.ledger import NO_BATCH, last_batch, record, with_news
from stratafold.operators.lookup import (
    FROM_HOME_TEAM,
    FROM_VENUE,
    LookupStep,
    coverage,
    lookup_cascade,
    prepare_lookup,
)
from stratafold.operators.merge import merge_into_nothing, merge_touched_partitions
from stratafold.operators.quality import bundled_suite, materialise_with_summary, run_suite
from stratafold.operators.quarantine import (
    BAD_PATH_DATE,
    NULL_MATCH_ID,
    count_invalid,
    quarantine_rows,
    split_invalid,
    write_quarantine,
)
from stratafold.operators.writers import land_json_by_date, overwrite_partitions
from stratafold.plans import contracts as c
from stratafold.sources.files import scan_dated_json, scan_table
from stratafold.sources.payload import finished, flatten_payload, landing_slice
from stratafold.workspace import cleans_up, materialise

logger = logging.getLogger(__name__)

MONTH = "match_month"

@cleans_up
def land_matches(spark: SparkSession, raw: DataFrame, staging: str, run_date: str) -> None:
    """Flatten raw match documents and land the finished ones, a folder per date.

    Everything up to the run's date if nothing was landed yet, else that date.
    """
    first_run = scan_dated_json(spark, f"{staging}/*/*.json", c.MATCH, documents=False) is None
    # A later run's slice implies this filter, which ends the parsing of other dates' documents early.
    wanted = raw if first_run else raw.filter(F.col("data_realizacao").startswith(run_date))
    flat = finished(flatten_payload(wanted, c.MATCH_SOURCE))
    land_json_by_date(landing_slice(flat, run_date, first_run=first_run), staging)


@cleans_up
def ingest_matches(
    spark: SparkSession,
    staging: str,
    bronze: str,
    quarantine: str,
    as_of: dt.datetime | None = None,
    *,
    full_refresh: bool = False,
    documents: bool = True,
) -> bool:
    """Take in every landed date from the newest ingested one on; False if none.

    The newest date is read again on purpose: its file may have been replaced.
    """
    as_of = as_of or dt.datetime.now()
    landed = scan_dated_json(spark, f"{staging.rstrip('/')}/*/*.json", c.MATCH, documents=documents)
    if landed is None:
        return False
    if not documents:
        # Landed by date folder, which then holds the column.
        landed = landed.withColumn("date", F.coalesce("date", "ingestion_date"))
    dated, undated = split_invalid(landed, [(BAD_PATH_DATE, F.col("ingestion_date") == "")])
    if not undated.isEmpty():
        rows = undated.withColumn("ingested_at", stamp(as_of))
        today = as_of.date().isoformat()
        # Such a file is met again on every run: one record a day is enough.
        write_quarantine(quarantine_rows(rows, c.MATCH_QUARANTINED, today, as_of), quarantine, replace=True, batch=NO_BATCH)

    newest = listed_watermark(spark, bronze, "ingestion_date")
    batch = last_batch(spark, bronze, scan_table(spark, bronze, c.MATCH_BRONZE), "ingest_batch", "ingestion_date") + 1
    fresh = increment(dated, "ingestion_date", newest, full_refresh=full_refresh)
    fresh = fresh.withColumns(
        {
            "ingested_at": stamp(as_of),
            "ingestion_ts": logical_timestamp("ingestion_date"),
            "ingest_batch": F.lit(batch).cast("bigint"),
        }
    )
    staged = materialise(fresh, "match-bronze")
    if staged.isEmpty():
        return False
    run_suite(staged, bundled_suite("match_bronze"))
    per_date = rows_per_date(staged)
    counts = {r.ingestion_date: r.rows for r in per_date.collect()}
    logger.info("rows per date: %s", counts)
    record(per_date, bronze, batch, as_of)
    overwrite_partitions(staged.select(*c.MATCH_BRONZE.names), bronze, ["ingestion_date"], single=len(counts) == 1)
    return True


def rows_per_date(df: DataFrame, date_column: str = "ingestion_date") -> DataFrame:
    """What a run is about to write, by date."""
    return df.groupBy(date_column).agg(F.count("*").alias("rows")).orderBy(date_column)


def derive_match_columns(df: DataFrame) -> DataFrame:
    """Fold accents, parse dates and times, derive total and outcome."""
    return df.withColumns(
        {
            "home_team": strip_accents("home_team"),
            "away_team": strip_accents("away_team"),
            "stadium": strip_accents("stadium"),
            "match_date": parse_date("date"),
            "kickoff_ts": compose_timestamp("date", "kickoff_time"),
            "total_goals": total("score_home", "score_away"),
            "match_outcome": outcome("score_home", "score_away"),
        }
    )


def add_stadium_state(df: DataFrame) -> DataFrame:
    """The state a match was played in: by stadium, else by home team, else unknown."""
    spark = df.sparkSession
    stadiums = prepare_lookup(c.bundled_table(spark, "stadium_states"), "stadium", "state")
    teams = prepare_lookup(c.bundled_table(spark, "home_team_states"), "home_team", "state")
    return lookup_cascade(
        df,
        [LookupStep(stadiums, "stadium", FROM_VENUE), LookupStep(teams, "home_team", FROM_HOME_TEAM)],
        value_column="stadium_state",
        origin_column="stadium_state_origin",
    )


@cleans_up
def transform_matches(
    spark: SparkSession,
    bronze: str,
    silver: str,
    quarantine: str,
    watermarks: str,
    as_of: dt.datetime | None = None,
    *,
    full_refresh: bool = False,
    touch: str = "changed",
) -> bool:
    """Merge bronze rows not yet merged into the current state; False if none.

    Every ingest has a number and a note of the dates it brought.  The last number merged is kept in a
    small table of its own, so only dates with news are read, a run without news opens no bronze file, a batch landed while a merge runs is not
    passed over, and one whose rows are all bad is taken once.  A repeated batch replaces its quarantine records.
    Only months a change falls in are rewritten, after their new rows are checked.
    """
    as_of = as_of or dt.datetime.now()
    landed = scan_table(spark, bronze, c.MATCH_BRONZE)
    if landed is None:
        return False
    seen = high_watermark(scan_table(spark, watermarks), "merged_batch")
    # The files are listed here, once: should an ingest replace one before it is read, this run fails and marks nothing.
    fresh = landed if full_refresh else with_news(landed, bronze, "ingest_batch", "ingestion_date", seen)
    if fresh is None:
        return False
    newest = high_watermark(fresh, "ingest_batch")
    if newest is None:
        return False

    def keep_mark() -> None:
        mark = spark.createDataFrame([(newest, as_of)], "merged_batch BIGINT, merged_at TIMESTAMP")
        mark.coalesce(1).write.mode("append").parquet(watermarks)

    rules = [(NULL_MATCH_ID, F.col("ge_match_id").isNull())]
    good, bad = split_invalid(fresh, rules)
    rows, invalid = count_invalid(fresh, rules)
    if invalid:
        logger.warning("%d of %d rows go to quarantine", invalid, rows)
        today = as_of.date().isoformat()
        write_quarantine(quarantine_rows(bad, c.MATCH_QUARANTINED, today, as_of), quarantine, replace=True, batch=newest)
    if rows == invalid:
        keep_mark()
        return False

    ties = ["ingestion_date", "date", "kickoff_time", "score_home", "score_away", "stadium"]
    latest = latest_per_key(good, ["ge_match_id"], "ingested_at", ties)
    enriched = add_stadium_state(derive_match_columns(latest))
    # Date folders and months are partition values: every row needs a date.
    source, _ = materialise_with_summary(
        enriched.withColumn(MONTH, month_of("match_date")).select(
            *[n for n in c.MATCH_SILVER.names if n in enriched.columns], MONTH
        ),
        "match-source",
        "silver",
        ["ge_match_id", "match_date", "stadium_state"],
    )
    stored = c.T.StructType([*c.MATCH_SILVER.fields, c.T.StructField(MONTH, c.T.DateType())])
    options = {
        "partition": MONTH,
        "keys": ["ge_match_id"],
        "update": c.MATCH_UPDATED,
        "as_of": as_of,
        "touch": touch,
        "source_is_unique": True,
        "audit": lambda staged: run_suite(staged, bundled_suite("match_silver")),
    }
    current = scan_table(spark, silver, stored)
    if current is None:
        merge_into_nothing(source, stored, silver, **options)
    else:
        merge_touched_partitions(current, source, silver, **options)
    logger.info("origins of states: %s", {r.stadium_state_origin: r.rows for r in coverage(source, "stadium_state_origin").collect()})
    keep_mark()
    return True


def read_matches(spark: SparkSession, silver: str) -> DataFrame | None:
    """The current state of all matches."""
    stored = scan_table(spark, silver)
    return None if stored is None else stored.select(*c.MATCH_SILVER.names)
