"""Documents to packed training sequences, in stages that each work on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlight.llm import decontaminate, packing, quality, secrets, simhash
from martlight.llm.queries import table
from martlight.session import remove, scratch_tables, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that are boilerplate of their source."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: 64-bit fingerprints of 4-word shingles, linked at 4 bits or fewer."""
    return simhash.drop_near_duplicates(docs, shingle=4, distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in their sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# SimHash and token ids have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's result is written and read again.

    What a stage stored on its way, and the result before its own, are removed once its own is written.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        with scratch_tables(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if last is not None:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
