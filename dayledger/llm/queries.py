"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayledger.llm.jaccard import jaccard_components
from dayledger.llm.language import language_report
from dayledger.llm.licences import licence_report
from dayledger.llm.lines import LINES_SQL, dedup_lines
from dayledger.llm.mixing import MIX_SQL, mix
from dayledger.llm.packing import packing_report
from dayledger.llm.quality import QUALITY_SQL, quality_report
from dayledger.llm.repair import repair_report
from dayledger.llm.repeats import runs_report
from dayledger.llm.substrings import substring_report
from dayledger.llm.tokens import count_report
from dayledger.llm.toxicity import toxicity_report
from dayledger.llm.vectors import near_vectors
from dayledger.session import prepare, table


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_report(table(prepare(spark), folder, "documents"))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(prepare(spark), folder, "documents"), width=3, percent=90)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(prepare(spark), folder, "documents"))


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(prepare(spark), folder, "documents").select("doc_id", "source", "text"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_report(table(prepare(spark), folder, "documents"), tokenizer("piece_bpe_32k.model"), 4096)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(prepare(spark), folder, "documents").select("doc_id", "text"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing_report(table(prepare(spark), folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_embedding_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(prepare(spark), folder, "embeddings"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_report(table(prepare(spark), folder, "documents"), table(spark, folder, "labels"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_report(table(prepare(spark), folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs_report(table(prepare(spark), folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_report(table(prepare(spark), folder, "conversations"))


def op13_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licence_report(table(prepare(spark), folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_ngram_jaccard, op3_quality_rules, op4_mix_sources, op5_token_counts, op6_line_dedup, op7_packing,
        op8_embedding_near_dups, op9_toxicity, op10_language_id, op11_periodic_runs, op12_conversation_repair, op13_licence_scan,
    )
}
ORACLES: dict[str, str] = {"op3_quality_rules": QUALITY_SQL, "op4_mix_sources": MIX_SQL, "op6_line_dedup": LINES_SQL}
