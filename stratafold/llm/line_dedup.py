"""Removal of boilerplate lines: those that many different sites carry.

Each line's sites are counted by a HyperLogLog sketch, merged while aggregating, so a line
that a third of all documents hold costs one sketch per map task.  Lines whose estimate is
too close to the threshold to trust get an exact count of distinct sites.  Of a line found
to be boilerplate the first occurrence stays, all others go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.rows import unused_name
from stratafold.operators.joins import broadcast_if_small
from stratafold.workspace import materialise

# Different sites that make a line boilerplate.  Low, because where one site holds much of a table a passage in many
# documents is on few: of 20 documents, 4 sites are missed with a chance of 4e-4 if a site holds half of all rows and
# 19 share the rest, 10 sites with one of 0.65 (simulated).
SITES = 4
# Those of the query that ``SQL`` checks.
SQL_SITES = 10
# Registers of a sketch: 2 to this power; its relative error is 1.04 / sqrt(registers).
LOG_REGISTERS = 12
# Estimates within so many errors (and one site) of the threshold are counted exactly.
ERRORS = 4

LINE = ["line_hash", "line_check"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _without(lines: Column, gone_at: Column) -> Column:
    """The lines at other positions than those given, in order."""
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone_at)
    return F.transform(places, lambda i: F.get(lines, i))


def drop_boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs`` without boilerplate lines and without documents that had nothing else.

    As ``drop_spread_lines``, but without its count: a document that lost lines and has only white
    space left goes, and a column ``n_chars`` follows the text.
    """
    cleaned = drop_spread_lines(docs, sites)
    removed = F.col(cleaned.columns[-1])
    kept = cleaned.filter((removed == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(removed > 0, length).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def line_table(docs: DataFrame) -> DataFrame:
    """One narrow row per line that is not blank: where it is, its site, and 96 bits of hash."""
    # The hash of the text comes before the lines do: beside them it would be computed for each.
    keyed = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), "text")
    placed = keyed.select("doc_id", "source", "text_key", F.posexplode(_lines(F.col("text"))).alias("position", "line"))
    plain = F.trim(F.col("line"))
    return (
        placed.filter(F.length(plain) > 0)
        .withColumn("plain", plain)
        .select("doc_id", "text_key", "position", "source", F.xxhash64("plain").alias("line_hash"), F.hash("plain").alias("line_check"))
    )


def spread_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """Hashes of lines on at least ``sites`` sites, with the first place (doc_id, text_key, position)."""
    error = ERRORS * 1.04 / (2**LOG_REGISTERS) ** 0.5
    sketched = lines.groupBy(LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("source", LOG_REGISTERS)).alias("estimate"),
        F.min(F.struct("doc_id", "text_key", "position")).alias("first"),
    )
    likely = materialise(sketched.filter(F.col("estimate") >= sites * (1 - error) - 1), "spread-likely")
    sure = F.col("estimate") > sites * (1 + error) + 1
    close = likely.filter(~sure)
    counted = (
        lines.join(broadcast_if_small(close.select(LINE)), LINE, "left_semi")
        .filter("source IS NOT NULL")
        .groupBy(*LINE, "source")
        .agg(F.lit(1).alias("one"))
        .groupBy(LINE)
        .agg(F.count("*").alias("exact"))
        .filter(F.col("exact") >= sites)
    )
    return likely.filter(sure).select(*LINE, "first").unionByName(close.join(counted, LINE).select(*LINE, "first"))


def drop_spread_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and how many (``n_removed``).

    Needs columns ``doc_id``, ``text`` and ``source`` (the site); all columns are kept, in
    order, and the count is put last (underscores before its name if a column has it).
    Lines end at ``\\n``, are compared without blanks at their ends, and blank ones stay.  A
    NULL source is no site.  NULL text stays NULL.  The first occurrence is that of the
    smallest doc_id (NULL first) and position; rows that repeat both doc_id and text are
    treated alike, so each keeps it.  A document may be left with an empty text.
    """
    name = unused_name(docs, "n_removed")
    lines = materialise(line_table(docs), "dedup-lines")
    spread = materialise(spread_lines(lines, sites), "dedup-spread")
    here = F.struct("doc_id", "text_key", "position")
    gone = (
        lines.join(broadcast_if_small(spread), LINE)
        .filter(~here.eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
        .agg(F.collect_set("position").alias("gone_at"))
    )
    # Most documents have such a line, so this table grows with the corpus: a shuffled join at every size.
    gone = materialise(gone, "dedup-gone").hint("merge")
    match = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"])
    # The array of one element makes a variable of the lines; what is left is found by hash, in one pass.
    left = F.transform(F.array(_lines(docs["text"])), lambda lines: _without(lines, gone["gone_at"]))[0]
    text = F.when(gone["gone_at"].isNull(), docs["text"]).otherwise(F.array_join(left, "\n")).alias("text")
    columns = [text if c == "text" else docs[c] for c in docs.columns]
    return docs.join(gone, match, "left").select(*columns, F.coalesce(F.size(gone["gone_at"]), F.lit(0)).cast("long").alias(name))


def line_dedup_digest(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """Per document what was removed, and a digest of the text that is left."""
    return drop_spread_lines(docs, sites).select(
        "doc_id",
        "n_removed",
        F.length("text").cast("long").alias("n_left"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


SQL = f"""
WITH split AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS position
    FROM documents
), lines AS (
    SELECT doc_id, source, position, line, trim(line, ' ') AS plain FROM split
), spread AS (
    SELECT plain FROM lines WHERE plain <> '' GROUP BY plain HAVING count(DISTINCT source) >= {SQL_SITES}
), ranked AS (
    SELECT doc_id, position, line,
           plain IN (SELECT plain FROM spread)
               AND row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS FIRST, position) > 1 AS gone
    FROM lines
), whole AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '') AS text
    FROM ranked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, length(whole.text) AS n_left, sha256(whole.text) AS text_sha256
FROM documents LEFT JOIN whole USING (doc_id)
"""
