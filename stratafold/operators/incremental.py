"""High watermarks and the rows beyond them."""

from __future__ import annotations

from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.operators.writers import NULL_PARTITION
from stratafold.sources.files import folder_entries


def high_watermark(table: DataFrame | None, column: str) -> Any | None:
    """The greatest value of a column; None for a missing or empty table.

    For a partition column ``listed_watermark`` opens no file at all.
    """
    if table is None:
        return None
    return table.agg(F.max(column)).first()[0]


def listed_watermark(spark: SparkSession, path: str, column: str) -> str | None:
    """The greatest value, as text, of a table's first partition column, from its folder names.

    No file is opened.  None for a missing table or one with the NULL partition only.
    """
    start = f"{column}="
    values = [unquote(e.name[len(start) :]) for e in folder_entries(spark, path) if e.name.startswith(start)]
    return max((v for v in values if v != NULL_PARTITION), default=None)


def increment(
    df: DataFrame,
    column: str,
    watermark: Any | None,
    *,
    inclusive: bool = True,
    full_refresh: bool = False,
) -> DataFrame:
    """Rows at or beyond (``inclusive``) or strictly beyond the watermark.

    No watermark, or ``full_refresh``, gives every row.  The watermark is a
    plain literal, so it prunes partitions and reaches the parquet filters.
    """
    if full_refresh or watermark is None:
        return df
    value = F.col(column)
    bound = F.lit(watermark).cast(df.schema[column].dataType)
    return df.filter(value >= bound) if inclusive else df.filter(value > bound)
