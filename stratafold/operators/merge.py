"""Keyed merges: upsert, soft delete, incremental fact, shrink guard.

A merge gives the next state of a table as a DataFrame; the caller writes it as
a new version (``operators.versions``) or over the partitions it touched
(``merge_touched_partitions``).  Nothing reads a path while replacing it.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratafold.functions.temporal import stamp
from stratafold.operators.incremental import high_watermark, increment
from stratafold.operators.joins import broadcast_if_small
from stratafold.operators.writers import in_partitions, one_partition, overwrite_partitions
from stratafold.workspace import cleans_up, materialise

# Fixed value: the largest share of active rows a new snapshot may lack.
MAX_SHRINK = 0.20


class SourceShrinkError(RuntimeError):
    """A snapshot is so much smaller than the table that it is likely partial."""


def merge_table(
    target: DataFrame,
    source: DataFrame,
    *,
    keys: Sequence[str],
    update: Sequence[str],
    as_of: dt.datetime | Column | None = None,
    on_missing: Literal["keep", "deactivate"] = "keep",
    touch: Literal["changed", "always"] = "changed",
    active: str | None = "is_active",
    stamped: str | None = "updated_at",
    evolve: bool = False,
    source_is_unique: bool = False,
) -> DataFrame:
    """The state of ``target`` after merging ``source``.

    * key in both: the ``update`` columns take the source's values, other
      columns keep their first value, the row is active again;
    * key in the source only: inserted, columns it lacks are NULL;
    * key in the target only: kept, or with ``deactivate`` marked inactive.

    ``touch="always"`` stamps every matched or missing row; ``"changed"`` only
    rows whose values or activity change, so that increments downstream see
    real changes only.  ``evolve`` appends columns the target does not have.

    The target is taken to hold each key once (audit it where that is not certain:
    rows that share a key are each updated).
    Two source rows of one key, or a NULL key, make the job fail, unless
    ``source_is_unique`` says the caller has seen to that (``split_invalid``,
    ``latest_per_key``).
    """
    columns = list(target.columns)
    added = [c for c in source.columns if c not in columns] if evolve else []
    managed = {c for c in (active, stamped) if c}
    updated = [c for c in [*update, *added] if c not in managed]
    from_source = set(source.columns)
    lacking = [c for c in [*keys, *update] if c not in from_source]
    if lacking:
        raise ValueError(f"merge source lacks {lacking}")

    now = stamp(as_of)
    if stamped:
        now = now.cast(target.schema[stamped].dataType)

    left = target.withColumn("_t", F.lit(True))
    right = source if source_is_unique else refuse_repeated_keys(source, keys)
    right = right.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    match = _all([F.col(k) == F.col(f"_s_{k}") for k in keys])
    joined = left.join(right, match, "full_outer")

    in_target, in_source = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    both = in_target & in_source

    changed = F.lit(False)
    for c in updated:
        before = F.lit(None) if c in added else F.col(c)
        changed = changed | ~before.eqNullSafe(F.col(f"_s_{c}"))
    if active:
        changed = changed | ~F.coalesce(F.col(active), F.lit(False))
    touched_match = both if touch == "always" else both & changed
    gone = in_target & ~in_source if on_missing == "deactivate" else F.lit(False)
    if active and touch == "changed":
        touched_gone = gone & F.coalesce(F.col(active), F.lit(True))
    else:
        touched_gone = gone

    out = []
    for c in columns:
        kind = target.schema[c].dataType
        new = F.col(f"_s_{c}").cast(kind) if c in from_source else F.lit(None).cast(kind)
        if c == active:
            value = F.when(in_source, F.lit(True)).when(gone, F.lit(False)).otherwise(F.col(c))
        elif c == stamped:
            value = F.when(~in_target | touched_match | touched_gone, now).otherwise(F.col(c))
        elif c in updated:
            value = F.when(in_source, new).otherwise(F.col(c))
        else:
            value = F.when(in_target, F.col(c)).otherwise(new)
        out.append(value.alias(c))
    out += [F.when(in_source, F.col(f"_s_{c}")).alias(c) for c in added]
    return joined.select(*out)


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result & c
    return result


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def refuse_repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` unchanged, or an error in its tasks if a key repeats or is NULL.

    NULL keys are refused before the shuffle, and at most two rows of a key
    leave a map task, so even a key repeated very often fails quickly.  The
    numbering uses the partitioning and order the merge join needs anyway.
    """

    def demand(condition: Column, message: str) -> Column:
        return F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))

    named = ", ".join(keys)
    keyed = source.filter(
        demand(_all([F.col(k).isNotNull() for k in keys]), f"merge source has NULL in its key: {named}")
    )
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    numbered = keyed.withColumn("_n", number).filter("_n <= 2")
    return numbered.filter(demand(F.col("_n") == 1, f"merge source has several rows of one key: {named}")).drop("_n")


@cleans_up
def merge_touched_partitions(
    target: DataFrame,
    source: DataFrame,
    path: str,
    *,
    partition: str,
    audit: Callable[[DataFrame], object] | None = None,
    **merge_options,
) -> None:
    """Merge into a partitioned table, rewriting only the partitions concerned.

    For merges that keep missing rows and never update the partition column.
    A partition is concerned if it holds a key of the source or if a new row
    belongs to it.  The new rows are written to the shared folder first, for
    they read the partitions they replace; ``audit`` sees them there and raises
    to leave the table as it is.
    """
    keys = list(merge_options["keys"])
    if merge_options.get("on_missing", "keep") != "keep":
        raise ValueError("soft deletes reach every partition: write a new version instead")
    if partition in merge_options["update"]:
        raise ValueError("the partition column must not be updated")
    wanted = broadcast_if_small(source.select(*keys).distinct())
    concerned = (
        target.select(*keys, partition)
        .join(wanted, keys, "left_semi")
        .select(partition)
        .union(source.select(partition))
        .distinct()
    )
    affected, count = in_partitions(target, materialise(concerned, "concerned"), partition)
    merged = merge_table(affected, source, **merge_options)
    staged = materialise(merged, "merged")
    if audit is not None:
        audit(staged)
    overwrite_partitions(staged, path, [partition], single=count == 1)


def merge_into_nothing(
    source: DataFrame,
    schema: StructType,
    path: str,
    *,
    partition: str,
    audit: Callable[[DataFrame], object] | None = None,
    **merge_options,
) -> None:
    """The first merge into a table of ``schema``: what ``merge_touched_partitions`` does to an empty one.

    There is nothing to join with and no partition to replace, so the rows go from ``source``, which
    should be a written table, straight to ``path`` once ``audit`` has passed them.
    """
    # A filter that never holds is seen by the optimizer, which then leaves out the join.
    nothing = source.sparkSession.createDataFrame([], schema).filter(F.lit(False))
    rows = merge_table(nothing, source, **merge_options)
    if audit is not None:
        audit(rows)
    overwrite_partitions(rows, path, [partition], single=one_partition(rows, partition))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key, for tables that ``merge_changed_buckets`` keeps."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits that stand for the values, NULLs included."""
    if not columns:
        return [F.lit(0).alias("_d0"), F.lit(0).alias("_d1")]
    texts = [F.col(c).cast("string") for c in columns]
    missing = F.concat(*[F.when(t.isNull(), "0").otherwise("1") for t in texts])
    return [F.xxhash64(missing, *texts).alias("_d0"), F.xxhash64(F.lit(1), *texts, missing).alias("_d1")]


@cleans_up
def merge_changed_buckets(
    target: DataFrame,
    source: DataFrame,
    path: str,
    *,
    bucket: str,
    audit: Callable[[DataFrame], object] | None = None,
    **merge_options,
) -> int:
    """Merge into a table partitioned by ``key_bucket``, rewriting only buckets with a change.

    Target and source both have the ``bucket`` column; soft deletes are allowed.  Which
    buckets hold a changed, new or gone key follows from a join of keys, activity and digests;
    the other columns are read, shuffled and written for these buckets alone.  ``audit`` sees
    their new rows and raises to leave the table as it is.  Returns how many buckets were rewritten.
    """
    keys, update = list(merge_options["keys"]), [c for c in merge_options["update"] if c in target.columns]
    active = merge_options.get("active", "is_active")
    deactivates = merge_options.get("on_missing", "keep") == "deactivate"
    always = merge_options.get("touch", "changed") == "always"
    if not merge_options.get("source_is_unique"):
        source = refuse_repeated_keys(source, keys)
        merge_options = {**merge_options, "source_is_unique": True}

    was_active = F.coalesce(F.col(active), F.lit(False)) if active else F.lit(True)
    left = target.select(*keys, F.col(bucket).alias("_tb"), was_active.alias("_active"), *_digest(update))
    right = source.select(*keys, F.col(bucket).alias("_sb"), *[d.alias(f"_s{i}") for i, d in enumerate(_digest(update))])
    both = left.join(right, keys, "full_outer")
    in_target, in_source = F.col("_tb").isNotNull(), F.col("_sb").isNotNull()
    differs = (F.col("_d0") != F.col("_s0")) | (F.col("_d1") != F.col("_s1")) | ~F.col("_active") | F.lit(always)
    gone = in_target & ~in_source & (F.col("_active") | F.lit(always)) & F.lit(deactivates)
    concerned = both.filter(~in_target | gone | (in_target & in_source & differs))
    touched = materialise(concerned.select(F.coalesce("_tb", "_sb").alias(bucket)).distinct(), "touched")

    affected, count = in_partitions(target, touched, bucket)
    if count:
        rows, _ = in_partitions(source, touched, bucket)
        staged = materialise(merge_table(affected, rows, **merge_options), "merged")
        if audit is not None:
            audit(staged)
        overwrite_partitions(staged, path, [bucket])
    return count


def merge_newer(
    target: DataFrame | None, source: DataFrame, *, keys: Sequence[str], changed_at: str, inclusive: bool = False
) -> DataFrame:
    """Incremental fact: rows newer than the target's newest are upserted.

    ``inclusive`` also takes rows as new as the newest, for sources where late rows
    bear a time already seen.  A missing or empty target takes everything; in any
    case two source rows of one key, or a NULL key, make the job fail.
    """
    fresh = increment(source, changed_at, high_watermark(target, changed_at), inclusive=inclusive)
    if target is None:
        return refuse_repeated_keys(fresh, keys)
    columns = [c for c in source.columns if c not in keys]
    return merge_table(
        target, fresh, keys=keys, update=columns, active=None, stamped=None, evolve=True
    )


def shrink_report(source: DataFrame, target: DataFrame, active: str = "is_active") -> DataFrame:
    """One row: active rows before, rows now, the least allowed, and the verdict.

    Both counts come from one aggregation.  No active rows before means nothing to lose.
    """
    before = target.filter(F.col(active)).select(F.lit(1).alias("_before"), F.lit(0).alias("_now"))
    now = source.select(F.lit(0).alias("_before"), F.lit(1).alias("_now"))
    counts = before.union(now).agg(
        F.count_if(F.col("_before") == 1).alias("previous_active"), F.count_if(F.col("_now") == 1).alias("current_rows")
    )
    threshold = F.floor(F.col("previous_active").cast("double") * F.lit(1 - MAX_SHRINK))
    return counts.withColumn("threshold", threshold.cast("bigint")).withColumn(
        "passed", (F.col("previous_active") == 0) | (F.col("current_rows") >= F.col("threshold"))
    )


def assert_not_shrinking(source: DataFrame, target: DataFrame | None, active: str = "is_active") -> None:
    """Stop a run whose snapshot has lost too many rows; a missing table passes."""
    if target is None:
        return
    row = shrink_report(source, target, active).first()
    assert_enough_rows(row.current_rows, row.previous_active)


def assert_enough_rows(current: int, previous_active: int) -> None:
    """The same on counts that are known already."""
    threshold = math.floor(previous_active * (1 - MAX_SHRINK))
    if previous_active and current < threshold:
        raise SourceShrinkError(f"source has {current} rows, {previous_active} were active before; at least {threshold} are needed")
