"""Split rows that break a rule from those that may go on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.functions.temporal import stamp
from stratafold.operators.writers import append_partitions, overwrite_partitions

Rule = tuple[str, Column]

# Reason codes.
NULL_ID = "NULL_ID"
NULL_MATCH_ID = "NULL_GE_MATCH_ID"
BAD_PATH_DATE = "BAD_PATH_DATE"
CORRUPT_DOCUMENT = "CORRUPT_DOCUMENT"


def split_invalid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry the first broken rule in ``quarantine_reason``.

    Together the two hold every input row once.  Both are plain filters, so a
    NULL check reaches the scan.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    broken = [(reason, F.coalesce(predicate, F.lit(False))) for reason, predicate in rules]
    any_broken = broken[0][1]
    reason = F.when(broken[0][1], broken[0][0])
    for code, predicate in broken[1:]:
        any_broken = any_broken | predicate
        reason = reason.when(predicate, code)
    good = df.filter(~any_broken)
    bad = df.filter(any_broken).withColumn("quarantine_reason", reason)
    return good, bad


def count_invalid(df: DataFrame, rules: Sequence[Rule]) -> tuple[int, int]:
    """(all rows, rows that break a rule), reading only what the rules look at."""
    broken = [F.coalesce(predicate, F.lit(False)) for _, predicate in rules]
    any_broken = broken[0]
    for predicate in broken[1:]:
        any_broken = any_broken | predicate
    row = df.agg(F.count("*"), F.count_if(any_broken)).first()
    return row[0], row[1]


def quarantine_rows(
    bad: DataFrame, keep: Sequence[str], quarantine_date: str, as_of: dt.datetime | Column | None = None
) -> DataFrame:
    """Quarantine records: kept columns, reason, time and date of the run."""
    return bad.select(
        *keep,
        "quarantine_reason",
        stamp(as_of).alias("quarantined_at"),
        F.lit(quarantine_date).alias("quarantine_date"),
    )


def write_quarantine(rows: DataFrame, path: str, *, replace: bool = False, batch: int | None = None) -> None:
    """Store quarantine records by date and reason, and by ``batch`` where batches are numbered.

    By default they are added, again on every rerun, for no evidence may get
    lost; ``replace`` puts them in the place of those of the same date, reason and batch.
    """
    by = ["quarantine_date", "quarantine_reason"]
    if batch is not None:
        rows, by = rows.withColumn("quarantine_batch", F.lit(batch).cast("bigint")), [*by, "quarantine_batch"]
    write = overwrite_partitions if replace else append_partitions
    write(rows, path, by)
