"""Cascading lookups: the first table that knows a key decides."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType

from stratafold.functions.text import strip_accents
from stratafold.operators.bloom import BLOCK_BITS, bitmaps, block_of, blocks_for, maybe_in
from stratafold.operators.buckets import row_digests
from stratafold.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, written_with_size
from stratafold.workspace import materialise

# Tags for where a value came from, and the value when none knows.
FROM_VENUE = "STADIUM_LOOKUP"
FROM_HOME_TEAM = "HOME_TEAM_FALLBACK"
FROM_NOWHERE = "UNKNOWN"
NO_VALUE = "UNKNOWN"

# Bits per key of a lookup's Bloom filter: one key in a thousand or two is joined in vain.
FILTER_BITS = 16
# Types whose equal values have equal texts.
FILTERED = (StringType, IntegerType, LongType, DateType)


@dataclass(frozen=True)
class LookupStep:
    """Look ``on`` up in a (``key``, ``value``) table; tag hits with ``origin``."""

    table: DataFrame
    on: Column | str
    origin: str
    key: str = "key"
    value: str = "value"
    # Up to both bounds the table is broadcast, beyond them the join shuffles.
    max_rows: int = MAX_BROADCAST_ROWS
    max_bytes: int = MAX_BROADCAST_BYTES
    # For keys that most rows do not have: beyond the bounds, rows that a Bloom filter of the keys rules out
    # skip the shuffle.  The rows are read twice for it, so they should be cheap to read (a scan).
    rarely_hit: bool = False
    max_filter_bytes: int = MAX_BROADCAST_BYTES


def prepare_lookup(
    table: DataFrame,
    key: str = "key",
    value: str = "value",
    normalise: Callable[[str], Column] = strip_accents,
) -> DataFrame:
    """A (``key``, ``value``) table with one row per normalised key.

    Keys that become equal are merged; if their values differ the job fails,
    for a join would otherwise repeat rows or pick a value by chance.
    """
    grouped = (
        table.filter(F.col(key).isNotNull())
        .groupBy(normalise(key).alias("key"))
        .agg(F.min(value).alias("low"), F.max(value).alias("high"))
    )
    clash = F.raise_error(F.concat(F.lit("lookup key has several values: "), F.col("key")))
    agreed = F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low")).otherwise(clash)
    return grouped.select("key", agreed.cast(table.schema[value].dataType).alias("value"))


def lookup_left(df: DataFrame, step: LookupStep, into: str) -> DataFrame:
    """Left join of one lookup table, its value in column ``into``; the rows are the same whichever way it goes."""
    on = F.col(step.on) if isinstance(step.on, str) else step.on
    known = step.table.select(F.col(step.key).alias("_key"), F.col(step.value).alias(into))
    known, rows, size = written_with_size(known, "lookup")
    if rows <= step.max_rows and size <= step.max_bytes:
        known = F.broadcast(known)
    elif step.rarely_hit and blocks_for(rows, FILTER_BITS) * BLOCK_BITS <= 8 * step.max_filter_bytes:
        same = df.select(on.alias("on")).schema["on"].dataType == known.schema["_key"].dataType
        if same and isinstance(known.schema["_key"].dataType, FILTERED):
            return _lookup_possible(df, on, known, rows, into)
    return df.join(known, on == F.col("_key"), "left").drop("_key")


def _lookup_possible(df: DataFrame, on: Column, known: DataFrame, rows: int, into: str) -> DataFrame:
    """The same left join, of rows whose key a broadcast Bloom filter of the known keys lets through."""
    blocks = blocks_for(rows, FILTER_BITS)
    d0, d1 = row_digests(["_key"])
    keys = known.filter(F.col("_key").isNotNull()).select(d0.alias("d0"), d1.alias("d1"))
    made = materialise(bitmaps(keys, "d0", "d1", blocks), "lookup-filter").select(F.col("block").alias("_block"), F.col("bitmap").alias("_bitmap"))
    d0, d1 = row_digests(["_on"])
    placed = df.withColumn("_on", on).withColumns({"_d0": d0, "_d1": d1}).withColumn("_block", block_of("_d0", blocks))
    tried = placed.join(F.broadcast(made), "_block", "left")
    possible = F.col("_on").isNotNull() & F.coalesce(maybe_in("_bitmap", "_d1"), F.lit(False))
    joined = tried.filter(possible).select(*df.columns, "_on").join(known, F.col("_on") == F.col("_key"), "left").select(*df.columns, into)
    value = F.lit(None).cast(known.schema[into].dataType).alias(into)
    return joined.unionByName(tried.filter(~possible).select(*df.columns, value))


def lookup_cascade(
    df: DataFrame,
    steps: Sequence[LookupStep],
    *,
    value_column: str,
    origin_column: str,
    no_value: str = NO_VALUE,
    no_origin: str = FROM_NOWHERE,
) -> DataFrame:
    """Try each step in turn; add the value found and the origin of the hit.

    Each table must be unique on its key (see ``prepare_lookup``), which keeps
    the row count unchanged.
    """
    if not steps:
        raise ValueError("at least one lookup step is needed")
    found = []
    for number, step in enumerate(steps):
        hit = f"_hit_{number}"
        df = lookup_left(df, step, hit)
        found.append((hit, step.origin))
    value = F.coalesce(*[F.col(hit) for hit, _ in found], F.lit(no_value))
    origin = F.when(F.col(found[0][0]).isNotNull(), found[0][1])
    for hit, tag in found[1:]:
        origin = origin.when(F.col(hit).isNotNull(), tag)
    return (
        df.withColumn(value_column, value)
        .withColumn(origin_column, origin.otherwise(no_origin))
        .drop(*[hit for hit, _ in found])
    )


def coverage(df: DataFrame, origin_column: str) -> DataFrame:
    """How many rows each origin served."""
    return df.groupBy(origin_column).agg(F.count("*").alias("rows"))
