"""One row per key: the latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the greatest ``latest_by`` of each key; ``ties`` settle equal ones.

    A filter of ``row_number`` to 1 is also applied before the shuffle, so each
    map task sends at most one row per key and a hot key stays small.
    """
    _require_ties(ties)
    order = [F.col(latest_by).desc(), *[F.col(t).desc() for t in ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_per_key_agg(df: DataFrame, keys: Sequence[str], latest_by: str, ties: Sequence[str]) -> DataFrame:
    """The same rows by ``max_by``: cheaper where keys repeat a lot within a task."""
    _require_ties(ties)
    rest = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), F.struct(latest_by, *ties)).alias("_row")
    return df.groupBy(*keys).agg(winner).select(*keys, "_row.*").select(*df.columns)


def _require_ties(ties: Sequence[str]) -> None:
    if not ties:
        raise ValueError("name at least one tie-break column: rows of one batch share their timestamp")
