"""The registered opN_* queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, hard_negatives, html_extract, langid, licenses, mixing, phrases, quality_rules, ranker,
               secrets, simhash, toxicity, url_filter)
from .common import table


def _fold(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return (html_extract.extract(spark, table(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix: its size and the words taken of it."""
    return mixing.mix(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL judged by the fixed rules and the vocabulary."""
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("url")


def op4_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = ranker.train(docs, table(spark, sf_dir, "labels").where(_fold(3) != 1))
    return ranker.score(docs, model).select("doc_id", (_fold(3) == 1).alias("held_out"), "score",
                                            (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's canonical digest, its licence and the licence notices in it."""
    return (licenses.scan(spark, table(spark, sf_dir, "documents"))
            .withColumn("notices", F.array_join("notices", ",")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(spark, docs.where(_fold(5) != 0))
    found = langid.identify(docs, model)
    return found.select("doc_id", (_fold(5) == 0).alias("held_out"), langid.predicted(F.col("lang")).alias("lang_pred"),
                        "score", "cross_entropy", "accepted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base statistics and the cascade's verdict."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.plan(docs))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds: where its tokens are and how many are equal."""
    return decontaminate.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the least document that its links reach."""
    found = simhash.dedup(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, as spans of code points."""
    found = secrets.scan(spark, table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE],
                        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels").where(_fold(5) != 0))
    return toxicity.score(docs, model).select("doc_id", (_fold(5) == 0).alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor's positives and the hard negatives of each."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's best phrases."""
    return phrases.mine(spark, table(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_source_mixing, op3_url_filter, op4_quality_ranker, op5_license_scan,
    op6_language_id, op7_quality_rules, op8_decontamination, op9_simhash_dedup, op10_secret_scan,
    op11_toxicity, op12_hard_negatives, op13_phrases)}
