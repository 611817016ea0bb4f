"""A corpus pipeline of the llm operators: each stage takes what its predecessor kept.

``run`` writes every stage's result as Parquet under the shared checkpoint folder
and reads it again, so that a lost executor never costs an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quartermaster.llm import decontaminate, mixing, quality_rules, secrets, simhash
from quartermaster.llm.common import materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return docs.where(quality_rules.keep(docs["text"], quality_rules.plan(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one of the least id."""
    return simhash.keep_one(spark, docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secrets.redacted(spark, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document that is left."""
    return mixing.mix(spark, docs).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]
# Fingerprint components and hash-drawn rounding are beyond SQL; the tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
