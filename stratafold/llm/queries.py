"""The queries over these operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.llm import chat, decontaminate, exact_dedup, lexical, licenses, line_dedup, near_dedup, packing, periodic, pii, quality, token_files, warc
from stratafold.llm.rows import read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.best_fit(packing.token_lengths(docs, TOKENIZER))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts are control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = [F.struct(F.lit(turn).alias("turn"), F.lit(role).alias("role")) for turn, role in enumerate(("user", "assistant"))]
    hostile = spark.range(1).select(F.explode(F.array(*said)).alias("t")).select(
        F.lit(-1).alias("conv_id"), "t.turn", "t.role", F.lit(chat.HOSTILE).alias("text")
    )
    return chat.conversation_digest(chat.format_conversations(turns.unionByName(hostile)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, read_table(spark, sf_dir, "documents"), TOKENIZER)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(read_table(spark, sf_dir, "documents"), line_dedup.SQL_SITES)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture and a revisit derived from every page; the revisits resolved."""
    return warc.revisit_digest(warc.resolve_revisits(warc.records_of_pages(read_table(spark, sf_dir, "pages"))))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), licenses.template_table(spark))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in all documents, a tenth of which are made periodic from some word on."""
    docs = periodic.with_periodic_tails(read_table(spark, sf_dir, "documents"))
    return periodic.runs_digest(periodic.periodic_runs(docs))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_token_files": op3_token_files,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_license_scan": op7_license_scan,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_pii": op13_pii,
}

ORACLES: dict[str, str] = {
    "op2_chat_formatting": chat.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_warc_revisits": warc.SQL,
    "op7_license_scan": licenses.SQL,
    "op12_ranked_search": lexical.SQL,
}
