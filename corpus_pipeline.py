"""A corpus pipeline over ``documents``: each stage is one operator of ``stratafold.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, which are written
as Parquet and read again as the next stage's input; the last one returns packed pieces.
Empty input gives empty output in every stage, and columns beyond those named are passed on
up to the last stage.  What a stage does with NULL texts and the like is said in its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratafold.llm import decontaminate, line_dedup, near_dedup, packing, quality
from stratafold.llm.queries import TOKENIZER
from stratafold.llm.rows import read_table
from stratafold.workspace import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates of the corpus: shared shingles of five words in percent of those of both.
NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, accepts."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; one that had nothing else goes.  ``n_chars`` is kept true."""
    return line_dedup.drop_boilerplate(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (``NEAR_PERCENT``), that with the smallest doc_id."""
    return near_dedup.keep_one_of_near(docs, percent=NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row per piece of a document, with its bin."""
    return packing.best_fit(packing.token_lengths(docs, TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_boilerplate),
    ("minhash_near_dedup", keep_one_of_near),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

# Learned scores, linked groups and best-fit bins are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
