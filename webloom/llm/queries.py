"""The ten training-data queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import arrow_files, decontaminate, langid, line_dedup, packing, pii, quality, simhash, substring_dedup, tokens, url_filters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_vocabulary())


def op2_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_files.round_trip(table(spark, sf_dir, "documents"), tokens.default_vocabulary())


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), "spans")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_duplicates(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_best_fit_packing, op2_arrow_token_files, op3_personal_data, op4_benchmark_decontamination, op5_quality_rules, op6_simhash_near_dedup, op7_language_id, op8_line_dedup, op9_substring_dedup, op10_url_filters)
}
ORACLE_SQL: dict[str, str] = {"op5_quality_rules": quality.ORACLE, "op8_line_dedup": line_dedup.ORACLE, "op9_substring_dedup": substring_dedup.ORACLE}
