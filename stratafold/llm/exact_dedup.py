"""Exact dedup with the frequent digests taken out before anything is shuffled.

A Misra-Gries summary (the frequent-items sketch behind ``approx_top_k``) names the
digests that may be frequent, an exact count verifies them, and the verified few are
broadcast: their copies are settled in the map tasks.  All other digests go through an
ordinary shuffle, where by construction no group holds more than about a thousandth of
the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold.workspace import materialise

# Counters of a summary: the candidates, and so the broadcast, never exceed this many rows.
COUNTERS = 1024
# Reducers that merge the summaries of map tasks before the last one merges theirs.
MERGE_FAN = 64


def normalised_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of ASCII white space as one blank; NULL counts as empty."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(plain.cast("binary"), 256)


def frequent_digests(digests: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """Digests (column ``text_sha256``) with at least ``rows / counters`` copies, verified.

    Returns at most ``counters`` rows: text_sha256, keep_id, group_size.  The summary works
    on a 64-bit hash, in two levels; the exact count is on whole digests.
    """
    partial = (
        digests.select(F.xxhash64("text_sha256").alias("h"), F.pmod(F.spark_partition_id(), F.lit(MERGE_FAN)).alias("lane"))
        .groupBy("lane")
        .agg(F.expr(f"approx_top_k_accumulate(h, {counters})").alias("summary"))
    )
    # Grouped by a constant: an empty partition then has no summary to merge.
    merged = partial.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(summary, {counters}), {counters})").alias("top"))
    candidates = merged.select(F.explode("top").alias("t")).select(F.col("t.item").alias("h"))
    return (
        digests.join(F.broadcast(candidates), F.xxhash64("text_sha256") == F.col("h"), "left_semi")
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter((F.col("group_size") > 1) & (F.col("group_size") * counters >= rows))
    )


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Needs columns ``doc_id`` and ``text``; others may be there and are not read.  NULL text
    counts as empty text, so it equals an empty one.  Of equal texts the smallest doc_id
    stays; a NULL doc_id comes last, so it stays only in a group without any other.  Rows
    that repeat both text and doc_id are copies too: one of them stays.  Empty in, empty out.
    """
    digests = materialise(docs.select("doc_id", normalised_digest(F.col("text")).alias("text_sha256")), "exact-digests")
    rows = digests.count()
    frequent = materialise(frequent_digests(digests, rows, counters), "exact-frequent")

    marked = digests.join(F.broadcast(frequent), "text_sha256")
    # Only rows that carry the kept id can be the one that stays; repeats of it are ranked below.
    losers = marked.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.lit(False))
    first = Window.partitionBy("text_sha256").orderBy(F.col("doc_id").asc_nulls_last())
    winners = marked.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.row_number().over(first) == 1)

    group = Window.partitionBy("text_sha256")
    ordinary = (
        digests.join(F.broadcast(frequent), "text_sha256", "left_anti")
        .withColumn("kept", F.row_number().over(first) == 1)
        .withColumn("keep_id", F.min("doc_id").over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return losers.select(columns).unionByName(winners.select(columns)).unionByName(ordinary.select(columns))


SQL = """
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM d
"""
