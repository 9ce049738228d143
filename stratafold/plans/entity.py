"""Entity catalogue: daily snapshot to bronze, bronze to current state."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.temporal import logical_timestamp, stamp
from stratafold.functions.text import null_to_sentinel, strip_accents
from stratafold.operators.dedup import latest_per_key
from stratafold.operators.buckets import BUCKETS, BucketedTable
from stratafold.operators.merge import assert_enough_rows
from stratafold.operators.quality import bundled_suite, materialise_with_summary, run_suite
from stratafold.operators.quarantine import (
    CORRUPT_DOCUMENT,
    NULL_ID,
    count_invalid,
    quarantine_rows,
    split_invalid,
    write_quarantine,
)
from stratafold.operators.writers import overwrite_partitions
from stratafold.plans import contracts as c
from stratafold.sources.files import CORRUPT_COLUMN, partition, scan_json, scan_table
from stratafold.workspace import cleans_up, materialise

logger = logging.getLogger(__name__)

def with_ingest_columns(df: DataFrame, run_date: str, as_of: dt.datetime | None) -> DataFrame:
    return df.withColumns(
        {
            "ingested_at": stamp(as_of),
            "ingestion_ts": logical_timestamp(F.lit(run_date)),
            "ingestion_date": F.lit(run_date),
        }
    )


@cleans_up
def ingest_snapshot(
    spark: SparkSession,
    staging: str,
    bronze: str,
    run_date: str,
    as_of: dt.datetime | None = None,
    broken: str | None = None,
    *,
    documents: bool = True,
) -> int:
    """Read the day's landed pages, check them, replace that day's partition.

    The JSON is parsed once, into the shared folder; checks and the final write
    read columns from there.  Returns the rows written.  With ``broken``, documents that
    cannot be parsed go there with their text, the day's in place of those of an earlier
    run; without, each is a row of NULLs.  By default every file is one page; without ``documents``
    every line is, so that many pages share a file and large files are split.
    """
    folder = f"{staging.rstrip('/')}/{run_date}/"
    landed = scan_json(spark, folder, c.ENTITY, documents=documents, keep_corrupt=broken is not None)
    if broken is not None:
        parsed = materialise(landed, "entity-landed")
        lost = parsed.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col(CORRUPT_COLUMN).alias("document"))
        overwrite_partitions(quarantine_rows(lost.withColumn("quarantine_reason", F.lit(CORRUPT_DOCUMENT)), ["document"], run_date, as_of), broken, ["quarantine_date"])
        landed = parsed.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    staged, summary = materialise_with_summary(
        with_ingest_columns(landed, run_date, as_of), "entity-bronze", "bronze", ["id", "name", "brewery_type"]
    )
    run_suite(staged, bundled_suite("entity_bronze"))
    overwrite_partitions(staged, bronze, ["ingestion_date"], single=True)
    return summary["row_count"]


def clean_entities(good: DataFrame) -> DataFrame:
    """Fold accents of the state, name missing states, keep one row per id."""
    cleaned = good.withColumn("state", null_to_sentinel(strip_accents("state")))
    return latest_per_key(cleaned, ["id"], "ingested_at", c.ENTITY_ATTRIBUTES)


def silver_table(spark: SparkSession, root: str, buckets: int = BUCKETS) -> BucketedTable:
    """The current state, in buckets by id; ``buckets`` counts when the first version is written."""
    return BucketedTable(spark, root, c.ENTITY_SILVER, ("id",), buckets)


@cleans_up
def transform_snapshot(
    spark: SparkSession,
    bronze: str,
    silver_root: str,
    quarantine: str,
    run_date: str,
    as_of: dt.datetime | None = None,
    touch: str = "changed",
    buckets: int = BUCKETS,
) -> bool:
    """Merge one day's snapshot into the current state; False if there was nothing to merge.

    Entities missing from the snapshot become inactive, unless the snapshot is
    so small that it is likely partial.  Only key buckets in which something changes
    are read and written; their rows are checked before the new version is published.
    """
    as_of = as_of or dt.datetime.now()
    history = scan_table(spark, bronze, c.ENTITY_BRONZE)
    if history is None:
        return False
    snapshot = partition(history, "ingestion_date", run_date)
    rules = [(NULL_ID, F.col("id").isNull())]
    rows, invalid = count_invalid(snapshot, rules)
    good, bad = split_invalid(snapshot, rules)
    if invalid:
        logger.warning("%d of %d rows go to quarantine", invalid, rows)
        write_quarantine(quarantine_rows(bad, c.ENTITY_QUARANTINED, run_date, as_of), quarantine)
    if rows == invalid:
        return False

    source, counted = materialise_with_summary(clean_entities(good), "entity-source", "silver", ["id", *c.ENTITY_ATTRIBUTES])
    table = silver_table(spark, silver_root, buckets)
    assert_enough_rows(counted["row_count"], table.active_rows())
    rewritten = table.merge(
        source,
        update=c.ENTITY_ATTRIBUTES,
        as_of=as_of,
        on_missing="deactivate",
        touch=touch,
        source_is_unique=True,
        audit=lambda staged: run_suite(staged, bundled_suite("entity_silver")),
    )
    logger.info("%d buckets rewritten", rewritten)
    return True
