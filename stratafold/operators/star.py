"""Star schema: canonical dimensions, fact, coverage mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.functions.measures import percentage
from stratafold.functions.text import business_key, canonical, surrogate_key, trimmed
from stratafold.operators.ranking import dense_rank_within
from stratafold.workspace import materialise


def canonical_dimension(
    df: DataFrame, columns: Sequence[str], key: str, *, show: Literal["max", "min"]
) -> DataFrame:
    """One row per canonical value of ``columns``, with a surrogate key.

    Spellings that differ in case or outer spaces fall together; the greatest or
    least trimmed spelling is shown.  Distinct spellings are found first: that
    step hashes and combines before its shuffle, so only they are sorted.  (The
    repartition gives each canonical value one place, and keeps the optimizer
    from folding both steps into one sort of every row.)
    """
    forms = {c: f"_canonical_{c}" for c in columns}
    spellings = df.select(*[trimmed(c).alias(c) for c in columns]).distinct()
    placed = spellings.select(*columns, *[F.upper(c).alias(form) for c, form in forms.items()]).repartition(
        *forms.values()
    )
    pick = F.max if show == "max" else F.min
    shown = placed.groupBy(*forms.values()).agg(*[pick(c).alias(c) for c in columns])
    return shown.select(surrogate_key(*forms.values()).alias(key), *columns)


def describe_dimension(
    dimension: DataFrame,
    seed: DataFrame,
    column: str,
    *,
    seed_key: str,
    seed_text: str,
    into: str,
    match: Literal["canonical", "exact"] = "canonical",
) -> DataFrame:
    """Add a seed's description; values the seed lacks keep a NULL description.

    ``exact`` compares the shown spelling as it is, ``canonical`` ignores case
    and outer spaces.
    """
    form = canonical if match == "canonical" else F.col
    texts = seed.select(form(seed_key).alias("_seed"), F.col(seed_text).alias(into))
    return dimension.join(texts, form(column) == F.col("_seed"), "left").drop("_seed")


def build_fact(
    df: DataFrame,
    *,
    identifier: str,
    key: str,
    references: Mapping[str, Sequence[str]],
    carry: Sequence[str | Column],
) -> DataFrame:
    """One fact row per entity: keys by expression, no join and no shuffle."""
    return df.select(
        business_key(identifier).alias(key),
        *[surrogate_key(*columns).alias(name) for name, columns in references.items()],
        F.col(identifier).alias("id_business"),
        *carry,
    )


def coverage_mart(
    fact: DataFrame,
    locations: DataFrame,
    *,
    location_key: str,
    show: Sequence[str],
    rank_within: Sequence[str],
    names: Mapping[str, str],
    active: str = "is_active",
) -> DataFrame:
    """Active, inactive and all entities per location, active share, and rank.

    The fact is reduced to one row per location key before the join, so the
    join handles locations, not facts, and no location is hot in it.
    ``names`` maps active, inactive, total, ratio and rank to output names.
    """
    flag = F.col(active)
    per_key = fact.groupBy(location_key).agg(
        F.count_if(flag).alias("_active"),
        F.count_if(~flag).alias("_inactive"),
        F.count("*").alias("_total"),
    )
    located = per_key.join(locations.select(location_key, *show), location_key)
    mart = (
        located.groupBy(*show)
        .agg(
            F.sum("_active").alias(names["active"]),
            F.sum("_inactive").alias(names["inactive"]),
            F.sum("_total").alias(names["total"]),
        )
        .withColumn(names["ratio"], percentage(names["active"], names["total"]))
    )
    # Ranking reads the mart twice; written once, the facts are scanned once.
    return dense_rank_within(materialise(mart, "coverage"), rank_within, names["active"], names["rank"])
