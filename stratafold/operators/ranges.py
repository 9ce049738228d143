"""Ranges of equal row count, for keys that may hold more rows than one task should.

Rows are cut in order of key and time, so a key of any size is spread over as many ranges as it
fills.  What a range must know of the ranges before or after it concerns only keys that lie in
several: of the keys that begin or end a range, so at most two per range.  Such tables have a
size bound by the number of ranges and may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.workspace import materialise

RANGE = "_range"


def cut_into_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of about equal count (``RANGE``), by default as many as shuffle partitions."""
    cut = df.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    return materialise(cut.withColumn(RANGE, F.spark_partition_id()), "ranges")


def spanning_keys(ranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that lie in more than one range, a row each; fewer than there are ranges."""
    key = F.struct(*[F.col(k).alias(f"_k_{k}") for k in keys])
    ends = ranged.groupBy(RANGE).agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("ends"))
    each = ends.select(RANGE, F.explode("ends").alias("end"))
    return each.groupBy("end").agg(F.count("*").alias("n")).filter("n > 1").select("end.*")


def same_key(keys: Sequence[str]) -> Column:
    """Equality of ``keys`` with the columns of ``spanning_keys``, NULLs included."""
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return match


def carried(ranged: DataFrame, keys: Sequence[str], value: Column, over: Column, *, backwards: bool = False) -> DataFrame:
    """(``RANGE``, ``_k_`` key columns, ``carried``): what the ranges before give each range of a key that spans several.

    ``value`` aggregates a range's rows of the key; ``over`` is a window function's column over the
    ranges of the key, in terms of ``value``; ``backwards`` looks at the ranges behind instead.
    """
    wide = materialise(spanning_keys(ranged, keys), "spanning")
    parts = ranged.join(F.broadcast(wide), same_key(keys), "left_semi").groupBy(RANGE, *keys).agg(value.alias("value"))
    order = F.col(RANGE).desc() if backwards else F.col(RANGE)
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = parts.withColumn("carried", over.over(window)).filter("carried IS NOT NULL")
    return materialise(found.select(RANGE, *[F.col(k).alias(f"_k_{k}") for k in keys], "carried"), "carried")


def with_carried(ranged: DataFrame, keys: Sequence[str], table: DataFrame) -> DataFrame:
    """``ranged`` with ``_carried``, NULL where no other range has the key; its rows stay where they are."""
    named = table.select(F.col(RANGE).alias("_of_range"), *[f"_k_{k}" for k in keys], F.col("carried").alias("_carried"))
    match = (F.col(RANGE) == F.col("_of_range")) & same_key(keys)
    return ranged.join(F.broadcast(named), match, "left").drop("_of_range", *[f"_k_{k}" for k in keys])
