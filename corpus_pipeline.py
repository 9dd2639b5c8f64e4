"""From raw documents to packed sequences: the operators of webloom.llm, one after another.

Each stage gets all rows its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import common, decontaminate, line_dedup, packing, quality, simhash, tokens


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the threshold table reject go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; n_chars follows the text."""
    kept = line_dedup.drop_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest doc_id."""
    return simhash.first_of_groups(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences."""
    return packing.pack_documents(docs, tokens.default_vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express fingerprints, latent search or tokenising; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
