"""The corpus pipeline: documents through five stages, each written and read again.

Every stage works on all rows its predecessor kept. All but the last return the
columns of `documents`; the last adds size, source_size, target and taken, and
keeps the documents of which the mix takes words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyferry.llm import decontaminate, mixing, near_dup, pii, quality_rules
from keyferry.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dup.dedupe(docs, near_dup.Settings(words=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with identifiers and revealing terms replaced in the text."""
    cleaned = pii.sanitise(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with how many."""
    own = ["size", "source_size", "target", "taken"]
    kept = [F.col("kept_row")[c].alias(c) for c in docs.columns if c not in own]
    return mixing.mix(docs, with_row=True).where("taken > 0").select(*kept, *own)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("mix_sources", mixed),
]

# Near-duplicate groups and corpus disclosure counts are not a single SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
