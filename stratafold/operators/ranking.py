"""Ranks within groups that may be very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratafold.operators.ranges import RANGE, carried, cut_into_ranges, with_carried


def dense_rank_within(df: DataFrame, groups: Sequence[str], measure: str, into: str) -> DataFrame:
    """``dense_rank`` of ``measure``, greatest first, within ``groups``.

    A dense rank depends only on the distinct measures of a group.  Those are
    ranked, not the rows, so the window never holds a large group's rows; the
    ranks are then joined back, a join adaptive execution can split.  Where a group
    has more distinct measures than a task can sort, ``dense_rank_cut`` gives the same.
    """
    names = {c: f"_r_{c}" for c in [*groups, measure]}
    distinct = df.select(*[F.col(c).alias(a) for c, a in names.items()]).distinct()
    order = Window.partitionBy(*[names[g] for g in groups]).orderBy(F.col(names[measure]).desc())
    ranks = distinct.withColumn(into, F.dense_rank().over(order).cast("bigint"))
    return _with_ranks(df, ranks, names)


def _with_ranks(df: DataFrame, ranks: DataFrame, names: dict[str, str]) -> DataFrame:
    match = None
    for c, a in names.items():
        equal = F.col(c).eqNullSafe(F.col(a))
        match = equal if match is None else match & equal
    return df.join(ranks, match, "inner").drop(*names.values())


def dense_rank_cut(df: DataFrame, groups: Sequence[str], measure: str, into: str, *, ranges: int | None = None) -> DataFrame:
    """``dense_rank_within`` for groups with very many distinct measures; NULL measures come last.

    The distinct measures are cut, in order of group and measure, into ranges of about equal
    count.  A measure's rank is its place in its range and the number of those of its group in
    the ranges before: no window ever holds a whole group.
    """
    names = {c: f"_r_{c}" for c in [*groups, measure]}
    keys, value = [names[g] for g in groups], names[measure]
    distinct = df.select(*[F.col(c).alias(a) for c, a in names.items()]).distinct()
    order = [*[F.col(k) for k in keys], F.col(value).desc()]
    ranged = cut_into_ranges(distinct, order, ranges)
    place = F.row_number().over(Window.partitionBy(RANGE, *keys).orderBy(F.col(value).desc()))
    counted = carried(ranged, keys, F.count("*"), F.sum("value"))
    placed = with_carried(ranged.withColumn("_place", place), keys, counted)
    rank = (F.col("_place") + F.coalesce("_carried", F.lit(0))).cast("bigint")
    return _with_ranks(df, placed.select(*names.values(), rank.alias(into)), names)
