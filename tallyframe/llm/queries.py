"""The registered queries op1 to op13: each operator on its whole table, reduced to its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bag_minhash, cube_mix, decontaminate, divergence, html_blocks, importance, katz, license_join, passages, pii, quality_forest, suffix_dedup, toxicity


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_block_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract_main_text(_read(spark, folder, "pages"))


def op2_isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_forest.judge_quality(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op3_license_join(spark: SparkSession, folder: str) -> DataFrame:
    return license_join.scan_licenses(_read(spark, folder, "documents"))


def op4_suffix_automaton(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_benchmark_words(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op6_collinear_chains(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(_read(spark, folder, "documents"))


def op7_bag_minhash(spark: SparkSession, folder: str) -> DataFrame:
    classes = bag_minhash.near_duplicate_classes(_read(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "kept")


def op8_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.score_texts(_read(spark, folder, "documents"), held_out)


def op9_cube_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = cube_mix.mix_sources(_read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(_read(spark, folder, "documents")))


def op11_length_bucketed_crc(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op12_induced_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_read(spark, folder, "documents"))


def op13_pattern_tree(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit_sources(_read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_block_text,
        op2_isolation_forest,
        op3_license_join,
        op4_suffix_automaton,
        op5_weak_supervision,
        op6_collinear_chains,
        op7_bag_minhash,
        op8_katz_backoff,
        op9_cube_mix,
        op10_disclosure,
        op11_length_bucketed_crc,
        op12_induced_suffixes,
        op13_pattern_tree,
    )
}
