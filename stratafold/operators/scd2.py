"""Type-2 history: version intervals, incremental update, point in time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.operators.ranges import RANGE, carried, cut_into_ranges, with_carried
from stratafold.workspace import materialise

VALID_FROM = "valid_from"
VALID_TO = "valid_to"

# Versions of one key that a task can well sort; more of them are cut into ranges.
HOT_ROWS = 1_000_000
# Such keys at most, counters of a sketch, and sketches that are merged before the last step.
MAX_HOT = 1_000
COUNTERS = 8_192
PARTS = 256


def version_intervals(
    df: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    ties: Sequence[str],
    *,
    ranges: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every version of a key with the time it came and the time the next came.

    Of versions with the same key and time the last by ``ties`` counts.  A NULL
    key or time makes the job fail (``split_invalid`` sorts such rows out).

    Keys with about ``hot_rows`` versions or more are found by a sketch of frequent items.
    Their rows are cut, in order of key, time and ties, into ranges of about equal size: the
    next version is looked for within a key's range, and the last version there ends with the
    first one of the key's next range.  All other rows take one shuffle by key.  With
    ``ranges`` every row is cut, into so many ranges.
    """
    if not ties:
        raise ValueError("name at least one tie-break column")
    given = [*keys, changed_at]
    present = F.col(given[0]).isNotNull()
    for c in given[1:]:
        present = present & F.col(c).isNotNull()
    refuse = F.raise_error(F.lit(f"NULL among {', '.join(given)}")).cast("boolean")
    checked = df.filter(F.when(present, F.lit(True)).otherwise(refuse))
    if ranges:
        return _cut_intervals(checked, keys, changed_at, ties, ranges)
    hot = frequent_keys(checked, keys, hot_rows)
    if not hot:
        return _whole_intervals(checked, keys, changed_at, ties)
    is_hot = F.xxhash64(*keys).isin(hot)
    whole = _whole_intervals(checked.filter(~is_hot), keys, changed_at, ties)
    return whole.unionByName(_cut_intervals(checked.filter(is_hot), keys, changed_at, ties))


def frequent_keys(df: DataFrame, keys: Sequence[str], least: int) -> list[int]:
    """Hashes of the keys with at least ``least`` rows, and maybe of some with fewer; at most ``MAX_HOT``.

    One pass over the key columns; only summaries of fixed size leave its tasks.  A summary counts too
    low by no more than about four rows in ``COUNTERS``, which is allowed for.
    """
    hashed = df.select(F.xxhash64(*keys).alias("key"), F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"))
    parts = hashed.groupBy("part").agg(F.count("*").alias("rows"), F.expr(f"approx_top_k_accumulate(key, {COUNTERS})").alias("sketch"))
    # Grouped by a constant: an empty partition then has no sketch to merge.
    top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {COUNTERS}), {MAX_HOT})")
    found = parts.groupBy(F.lit(0).alias("all")).agg(F.sum("rows").alias("rows"), top.alias("top")).first()
    if found is None:
        return []
    floor = least - 4 * found["rows"] // COUNTERS
    return [t["item"] for t in found["top"] if t["count"] >= max(1, floor)]


def _versions(df: DataFrame, chained: DataFrame, changed_at: str, until: Column) -> DataFrame:
    """In time order with ties, the last row of an instant is the one whose successor is later."""
    last = chained.filter(until.isNull() | (until > F.col(changed_at)))
    return last.select(*df.columns, F.col(changed_at).alias(VALID_FROM), until.alias(VALID_TO))


def _whole_intervals(df: DataFrame, keys: Sequence[str], changed_at: str, ties: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(changed_at, *ties)
    return _versions(df, df.withColumn("_next", F.lead(changed_at).over(window)), changed_at, F.col("_next"))


def _cut_intervals(df: DataFrame, keys: Sequence[str], changed_at: str, ties: Sequence[str], ranges: int | None = None) -> DataFrame:
    ranged = cut_into_ranges(df, [F.col(c) for c in [*keys, changed_at, *ties]], ranges)
    within = Window.partitionBy(RANGE, *keys).orderBy(changed_at, *ties)
    following = carried(ranged, keys, F.min(changed_at), F.last("value"), backwards=True)
    chained = with_carried(ranged.withColumn("_next", F.lead(changed_at).over(within)), keys, following)
    return _versions(df, chained, changed_at, F.coalesce("_next", "_carried"))


def open_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNull())


def closed_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNotNull())


def apply_changes(
    history_open: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    ties: Sequence[str],
    *,
    ranges: int | None = None,
) -> DataFrame:
    """Open versions and a batch of changes, as the versions they become.

    The rows with an end are closed now and never change again: append them to
    the closed part; those without replace the open part.  The closed part is
    neither read nor rewritten.  Changes not newer than the open version are
    ignored, and keys missing from the batch stay open.
    """
    match = _equal({k: f"_o_{k}" for k in keys})
    open_keys = [F.col(k).alias(f"_o_{k}") for k in keys]
    known = history_open.select(*open_keys, F.col(VALID_FROM).alias("_o_from"))
    newer = materialise(
        batch.join(known, match, "left")
        .filter(F.col("_o_from").isNull() | (F.col(changed_at) > F.col("_o_from")))
        .select(*batch.columns),
        "newer",
    )
    added = version_intervals(newer, keys, changed_at, ties, ranges=ranges)
    first_change = newer.groupBy(*open_keys).agg(F.min(changed_at).alias("_ends"))
    kept = history_open.join(first_change, match, "left").withColumn(VALID_TO, F.col("_ends"))
    return kept.select(*history_open.columns).unionByName(added)


def _equal(pairs: Mapping[str, str]) -> Column:
    """Plain equality of column pairs: it can use a partitioning already there."""
    result = None
    for left, right in pairs.items():
        equal = F.col(left) == F.col(right)
        result = equal if result is None else result & equal
    return result


def as_of(history: DataFrame, instant: dt.datetime | Column) -> DataFrame:
    """The version of each key that was valid at ``instant``."""
    at = instant if isinstance(instant, Column) else F.lit(instant)
    end = F.col(VALID_TO)
    return history.filter((F.col(VALID_FROM) <= at) & (end.isNull() | (end > at)))


def as_of_join(
    points: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    ranges: int | None = None,
) -> DataFrame:
    """Each row of ``points`` with the version of its key that was valid at its own instant ``at``.

    All columns of ``points``, then those of ``history`` other than the keys, NULL where no version
    was valid or a key or the instant is NULL.  A version counts from ``valid_from`` on and up to, but
    not at, ``valid_to``.  ``history`` holds a key and ``valid_from`` once, as ``version_intervals`` gives it.

    Points and versions are put in one order of key and time and cut into ranges of about equal
    count; a range looks back within itself and else takes the key's last version of the ranges
    before.  So no row is repeated, and a key with half of all points and versions is spread.
    """
    kept = [c for c in history.columns if c not in keys]
    clash = sorted(set(kept) & set(points.columns))
    if clash:
        raise ValueError(f"both sides have {clash}")
    known = F.col(at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    nothing = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in kept]
    placeless = points.filter(~F.coalesce(known, F.lit(False))).select(*points.columns, *nothing)

    point = F.struct(*points.columns)
    version = F.struct(*[F.col(c) for c in (VALID_FROM, *[c for c in kept if c != VALID_FROM])])
    no_point = F.lit(None).cast(points.schema)
    asked = points.filter(known).select(*keys, F.col(at).alias("_time"), F.lit(1).alias("_turn"), point.alias("_point"))
    asked = asked.withColumn("_version", F.lit(None).cast(history.select(version.alias("v")).schema["v"].dataType))
    # At one instant a version comes before the points it is valid for.
    told = history.select(*keys, F.col(VALID_FROM).cast(points.schema[at].dataType).alias("_time"), F.lit(0).alias("_turn"), no_point.alias("_point"), version.alias("_version"))
    ranged = cut_into_ranges(asked.unionByName(told), [F.col(c) for c in [*keys, "_time", "_turn"]], ranges)

    within = Window.partitionBy(RANGE, *keys).orderBy("_time", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    before = carried(ranged, keys, F.max("_version"), F.last("value", ignorenulls=True))
    seen = ranged.withColumn("_seen", F.last("_version", ignorenulls=True).over(within)).filter("_turn = 1")
    found = with_carried(seen, keys, before).withColumn("_found", F.coalesce("_seen", "_carried"))
    open_ = F.col(f"_found.{VALID_TO}").isNull() | (F.col(f"_found.{VALID_TO}") > F.col("_time"))
    valid = [F.when(open_, F.col(f"_found.{c}")).alias(c) for c in kept]
    return found.select("_point.*", *valid).unionByName(placeless)
